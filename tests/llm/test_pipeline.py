"""The pipeline's stages on awkward rows: nulls, repeated rows and ids, clashing names, empty tables."""

import collections
import random

import corpus_pipeline as cp
import pytest
from test_models import story

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["1 as id", "2 as score", "3 as epochs", "4 as epoch", "'x' as row_key", "5 as times", "6 as turn", "7 as again", "8 as gone", "9 as count"]


def frame(spark, rows, *extra):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA).selectExpr("*", *extra)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "text").collect())


@pytest.fixture
def bench_dir(spark, scratch):
    """A table folder with a benchmark of two items and labels of the small table."""
    rng = random.Random(21)
    base = scratch("bench")
    items = [(1, story(rng, 40)), (None, story(rng, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{base}/labels.parquet")
    return base, [t for _, t in items]


def test_contaminated_rows_without_an_id_go_and_clean_ones_stay(spark, bench_dir):
    base, (first, second) = bench_dir
    rng = random.Random(1)
    clean = [(None, story(rng, 80), "a"), (None, None, "a"), (7, story(rng, 50), None), (7, "", "b")]
    dirty = [(None, f"{story(rng, 20)} {first} {story(rng, 20)}", "a"), (7, f"{second} {story(rng, 30)}", "a"), (8, first, "a"), (8, first, "a")]
    got = cp.drop_contaminated(spark, frame(spark, clean + dirty, *EXTRA), base)
    assert rows_of(got) == collections.Counter((i, t) for i, t, _ in clean)


def test_one_of_each_group_stays_without_ids_too(spark):
    rng = random.Random(2)
    a, b = story(rng, 60), story(rng, 60)
    rows = [(None, a, "s"), (None, a, "t"), (None, a + " more", "s"), (5, b, "s"), (5, b, "s"), (6, b, "s"), (9, None, "s"), (9, None, "s"), (10, "", "s")]
    got = rows_of(cp.drop_near_copies(spark, frame(spark, rows, *EXTRA), SF))
    assert sum(n for (_, t), n in got.items() if t and t.startswith(a)) == 1
    assert sum(n for (_, t), n in got.items() if t == b) == 1
    assert got[9, None] == 1 and got[10, ""] == 1 and sum(got.values()) == 4


def test_the_smallest_id_stays_where_ids_differ(spark):
    rng = random.Random(3)
    a, c = story(rng, 60), story(rng, 60)
    got = rows_of(cp.drop_near_copies(spark, frame(spark, [(4, a, "s"), (3, a, "s"), (8, c, "s"), (2, a + " x", "s")], *EXTRA), SF))
    assert got == {(2, a + " x"): 1, (8, c): 1}


@pytest.mark.parametrize("ids", ["differ", "repeat"])
def test_mixed_words_come_near_the_targets(spark, ids):
    """Rows that share an id are mixed one by one, so no target is overshot."""
    rng = random.Random(4)
    rows = [(k if ids == "differ" else (k % 3 or None), story(rng, rng.randrange(1, 40)), "abc"[k % 3]) for k in range(240)]
    rows += [rows[0], (9000, None, "a")] if ids == "repeat" else [(9000, None, "a")]
    docs = frame(spark, rows, *EXTRA)
    got = cp.mix_sources(spark, docs, SF)
    assert got.columns == docs.columns
    words = lambda t: len((t or "").split())
    total = sum(words(t) for _, t, _ in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    taken = collections.Counter()
    for r in got.collect():
        taken[r.source] += words(r.text)
    # weights 5, 2, 1 of one and a half times all words, no source above twice its own
    targets, left, weight, free = {}, 1.5 * total, dict(zip("abc", (5, 2, 1), strict=True)), set("abc")
    while True:
        share = left / sum(weight[s] for s in free)
        capped = {s for s in free if 2 * sizes[s] < share * weight[s]}
        if not capped:
            targets |= {s: share * weight[s] for s in free}
            break
        targets |= {s: 2 * sizes[s] for s in capped}
        left, free = left - sum(2 * sizes[s] for s in capped), free - capped
    assert all(abs(taken[s] - targets[s]) <= 40 for s in "abc")


def test_toxic_rows_go_and_a_score_column_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.selectExpr("*", "doc_id * 2 as score", "'y' as own_score")
    got = cp.reject_toxic(spark, more, SF)
    assert got.columns == more.columns and got.filter("score <> doc_id * 2").count() == 0
    assert rows_of(got) == rows_of(cp.reject_toxic(spark, docs, SF))
    odd = frame(spark, [(None, None, "a"), (1, "", None), (1, "", None)])
    assert cp.reject_toxic(spark, docs.unionByName(odd), SF).filter("text is null or text = ''").count() in (0, 3)


def test_empty_tables_go_through(spark, empty):
    docs = empty
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0 and docs.columns == empty.columns, name
    assert cp.write_token_ids(spark, docs, SF).count() == 0
