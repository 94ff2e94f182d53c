"""Merkle manifest, embedding whitening and language ids against plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import manifest, sha, whitening

from paxflow.llm import language, merkle, midstate
from paxflow.llm.whitening import Whitening, fit, whitened

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>"


def by_id(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


# ------------------------------------------------------------ Merkle manifest


@pytest.mark.parametrize("blocks", [1, 2, 16])
def test_midstates_are_sha256(blocks):
    rng = np.random.default_rng(blocks)
    digests = rng.integers(0, 2**32, (5, blocks, 8), np.uint32)
    state = midstate.initial(5)
    for k in range(blocks):
        state = midstate.absorb(state, midstate.hex_block(digests[:, k]))
    got = midstate.hex_text(midstate.finish(state, np.full(5, blocks)).T)
    want = [sha(midstate.hex_text(d).tobytes().decode()) for d in digests]
    assert [g.tobytes().decode() for g in got] == want
    # a stored state goes on where it was left
    again = midstate.from_bytes(midstate.to_bytes(state.T).tobytes()).T
    assert (midstate.finish(again, np.full(5, blocks)) == midstate.finish(state, np.full(5, blocks))).all()


def rows_of(n, sources, seed):
    rng = random.Random(seed)
    return [(k, f"Text {k} É" * (k % 4), "de", rng.choice(sources), k if k % 3 else None) for k in range(n)]


def check(spark, rows, *extra):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *extra)
    got = [tuple(r) for r in merkle.manifest_digest(docs).collect()]
    assert sorted(got, key=by_id) == sorted(manifest(rows), key=by_id)
    return got


def test_manifest_with_awkward_rows(spark):
    rows = [(None, "x", None, "a", 1), (None, "x", None, "a", 1), (1, None, None, None, None), (1, "Ab", "e", None, 2), (2, "", "e", "", 0)]
    rows += [(3, "Long É " * 20_000, "fr", "é", 9)] + rows_of(600, ["s", "t", None, "ü", "-", "="], 1)[4:]
    got = check(spark, rows, "1 as idx", "2 as key", "3 as n", "4 as leaf", "5 as page")
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_manifest_of_one_source(spark, n):
    check(spark, rows_of(n, ["one"], n))


def test_manifest_of_many_sources(spark):
    check(spark, rows_of(700, [f"host{k}" for k in range(300)], 5))


def test_a_source_of_several_pages(spark):
    """More leaves than one page of three levels holds, one of them alone in its run."""
    got = check(spark, [(k, f"T{k}", None, "hot" if k % 50 else "cold", k) for k in range(merkle.PAGE + 300)])
    assert not all(r[-1] for r in got)


def test_a_changed_leaf_is_found_by_its_state_alone(spark):
    """Folding reads the stored states and right siblings, never the left ones."""
    rows = rows_of(300, ["a", "b"], 2)
    docs = spark.createDataFrame(rows, DOCS)
    leaves = docs.selectExpr("concat('=', source) as key", "doc_id", "unhex(sha2(text, 256)) as leaf", "unhex(sha2(concat(text, '!'), 256)) as new")
    tree = merkle.build_manifest(leaves, ("new",))
    assert tree.leaves.count() == 300 and tree.sources.count() == 2
    right = {r.doc_id: r.folded_root for r in merkle.fold(tree, "new").collect()}
    changed = leaves.selectExpr("key", "doc_id", "if(doc_id = 123, new, leaf) as leaf")
    root = merkle.build_manifest(changed).top_rounds[-1].first()["digest"]
    assert right[123] == bytes(root).hex()


def test_empty_manifest(spark, empty):
    assert merkle.manifest_digest(empty).collect() == []


# ------------------------------------------------------------------ whitening


def vectors(matrix):
    return [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(matrix)]


def check_white(spark, rows, *extra):
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", *extra)
    got = whitened(df).collect()
    ids, n, deviations, values, projected = whitening(rows)
    k = max(r.component for r in got)
    assert len(got) == k * n and {r.n for r in got} == {n}
    table = np.array([r.whitened for r in got]).reshape(n, k)
    assert sorted((r.vec_id is not None, r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted(
        (i is not None, i or 0, d) for i, d in zip(ids, deviations, strict=True)
    )
    assert [r.component for r in got[:k]] == list(range(1, k + 1))
    explained = np.array([r.explained for r in got[:k]])
    assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-6, atol=0)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error <= 1e-8
    assert np.abs(table.T @ table / n - np.eye(k)).max() <= 1e-8
    sign = np.sign((table * projected[:, :k]).sum(axis=0))
    assert np.abs(table * sign - projected[:, :k]).max() < 1e-6
    return k


def test_whitening(spark):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    rows = vectors((rng.normal(size=(500, 40)) * np.linspace(1, 8, 40)) @ turn)
    bad = [None, [], [1.0], [None] * 40, [math.nan] * 40, [math.inf] * 40, [0.5] * 39 + [None]]
    rows += [(None, v) for v in bad] + [(None, rows[0][1]), (7, rows[7][1]), (7, rows[7][1])]
    assert check_white(spark, rows, "1 as n", "2 as vector", "3 as component", "4 as at") == 32


def test_whitening_of_an_ill_conditioned_matrix(spark):
    """Variances over ten orders of magnitude; the Gram matrix alone would lose the small ones."""
    rng = np.random.default_rng(4)
    assert check_white(spark, vectors(rng.normal(size=(400, 20)) * np.logspace(4, -1, 20) + 300)) == 20


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(5)
    some = rng.normal(size=(200, 6)) * 9
    assert check_white(spark, vectors(np.c_[some, some[:, :2], np.full((200, 2), 3.0)])) in (6, 7, 8)
    few = spark.createDataFrame(vectors(rng.normal(size=(4, 10)) * 5), VECTORS)
    assert max(r.component for r in whitened(few).collect()) == 3


def test_whitening_without_rows_or_variance(spark):
    none = spark.createDataFrame([], VECTORS)
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VECTORS)
    assert whitened(none).collect() == [] and whitened(same).collect() == []
    assert fit(none)[1] is None


def test_deviations_stay_exact_beyond_64_bits():
    model = Whitening(10**7, (3 * 10**14 + 1, -5), np.empty((0, 2)), np.empty(0), 0.0)
    x = np.array([[30_000_000, 1 << 41], [29_999_999, -3]])
    want = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x]
    assert model.deviations(x) == want


# ----------------------------------------------------------------- languages


def strings(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    text = " " + " ".join(letters.split()) + " "
    return {text[i : i + n] for n in range(1, language.LONGEST + 1) for i in range(len(text) - n + 1)}


def test_kernel_values_are_counts_of_shared_strings():
    texts = ["The cat, the CAT sat.", "Der Kater saß auf der Matte", "", "日本 cat", "a", "123", "the" * 300]
    marks = language.Landmarks.of(texts[:2])
    shared = marks.presence * np.sqrt([len(strings(t)) for t in texts[:2]])
    for t in texts:
        text, at, sizes = language.known_strings(marks.letters, marks.codes, language.normal(pa.array([t])))
        own = strings(t) if any(c.isalpha() for c in t) else {" "}
        # letters that no landmark has count as one letter
        assert sizes[0] == len(own) or "日" in t or "cat" not in t
        got = np.rint(shared[at].sum(axis=0))
        if any(c.isalpha() for c in t):
            assert got.tolist() == [len(own & strings(m)) for m in texts[:2]]
    # in the Nystroem space, products of landmarks are their kernel values
    block = marks.features(language.normal(pa.array(texts[:2])))
    a, b = map(strings, texts[:2])
    assert np.allclose(block @ block.T, [[1, len(a & b) / math.sqrt(len(a) * len(b))]] * 1 + [[len(a & b) / math.sqrt(len(a) * len(b)), 1]], atol=1e-5)


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(8)
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["sch", "ein", "ter", "ung"], "zz": ["eau", "ille", "ont", "que"]}
    rows = []
    for k in range(360):
        lang = ("xx", "xx", "yy", "zz")[k % 4]
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 120))]
        rows.append((k, " ".join(words).title(), lang, "s", 1))
    rows += [
        (1000, None, "xx", "s", 0), (1001, "", "xx", "s", 0), (1002, "12 + 3!", "yy", "s", 0), (1003, "ω", "zz", "s", 1),
        (1004, "katomiru " * 40_000, None, "s", 1), (None, "schein", None, "s", 1), (1005, rows[2][1], "yy", "s", 1), (1005, rows[2][1], "yy", "s", 1),
    ]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as turn", "2 as draw", "'q' as lang_pred", "3 as id", "4 as at")


def test_languages(spoken):
    rows = language.languages(spoken).collect()
    real = [(r.doc_id, r.lang) for r in spoken.select("doc_id", "lang").collect()]
    assert len(rows) == len(real) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    named = {r.doc_id: r.lang_pred for r in rows}
    assert [named[k] for k in (1000, 1001, 1002, 1004, None, 1005)] == ["und", "und", "und", "xx", "yy", "yy"]
    assert named[1003] in ("xx", "yy", "zz")  # one letter, but a letter
    unseen = [(named[i], lang) for i, lang in real if i is not None and i < 1000 and zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(a == b for a, b in unseen) / len(unseen) > 0.95


def test_held_out_languages_train_nothing(spark, spoken):
    from pyspark.sql import functions as F

    lied = spoken.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "never").otherwise(F.col("lang")))
    answer = lambda docs: sorted((r.doc_id or -1, r.lang_pred, round(r.score, 9)) for r in language.languages(docs).collect())
    assert answer(lied) == answer(spoken)


def test_without_training_rows_nothing_is_determined(spark, spoken, empty):
    assert {(r.lang_pred, r.score) for r in language.languages(spoken.withColumn("lang", spoken["lang"].substr(9, 1)).filter("doc_id < 0")).collect()} == set()
    nothing = spoken.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.languages(nothing).collect()} == {("und", 0.0)}
    assert language.languages(empty).collect() == []
    one = spoken.filter("lang = 'yy'")
    assert {r.lang_pred for r in language.languages(one).collect()} == {"yy", "und"}


def test_queries_agree_with_brute_force_on_a_table(spark):
    from paxflow.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = [tuple(r) for r in queries.op11_merkle_manifest(spark, sf).collect()]
    assert sorted(got) == sorted(manifest(docs))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert check_white(spark, rows) == 32
    named = {r.doc_id: r for r in queries.op13_language_id(spark, sf).collect()}
    assert all(named[d[0]].lang_pred == d[2] for d in docs if named[d[0]].held_out and d[1])
    assert hashlib.sha256(b"").hexdigest() == sha("")
