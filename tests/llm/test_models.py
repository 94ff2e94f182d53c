"""Toxicity and decontamination on planted cases, and the pipeline's stages."""

import random

import pytest

from paxflow.llm.decontaminate import contaminated, lcs
from paxflow.llm.toxicity import held_out, toxicity

TWO = "doc_id long, text string"


def story(rng, n):
    syllables = ["an", "ther", "tion", "ou", "ble", "sh", "ing", "re", "ed", "st", "on", "ha"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(600):
        words = story(rng, rng.randrange(30, 200)).split()
        toxic = k % 3 == 0
        for _ in range(len(words) // 15 + 1 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vexblat", "grumpfor", "skulzen", "dreckmok"]))
        rows.append((k, " ".join(words)))
        marks.append((k, 0, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, rows[0][1]), (1002, rows[0][1])]
    return spark.createDataFrame(rows, TWO), spark.createDataFrame(marks, "doc_id long, quality long, toxic long")


def test_toxicity_of_held_out_rows(spark, judged):
    docs, labels = judged
    rows = toxicity(docs, labels).collect()
    assert len(rows) == 604 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id < 600]
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in unseen)
    assert right / len(unseen) > 0.95


def test_labels_of_the_held_out_fold_are_never_read(spark, judged):
    from pyspark.sql import functions as F

    docs, labels = judged
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda marks: {(r.doc_id, r.score) for r in toxicity(docs, marks).collect()}
    assert score(labels) == score(flipped)


def test_without_labels_nothing_is_toxic(spark, judged):
    docs, labels = judged
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}


def test_lcs():
    assert lcs([1, 2, 3, 4], [2, 9, 4, 3]) == 2 and lcs([], [1]) == 0 and lcs([1, 1, 2], [1, 2, 1, 2]) == 3


def test_decontamination(spark):
    rng = random.Random(9)
    items = [(k, story(rng, rng.randrange(15, 60)) + ". " + story(rng, 4)) for k in range(30)]
    docs = [(k, story(rng, rng.randrange(0, 400))) for k in range(120)]
    planted = set()
    for k in range(0, 60, 3):
        item, words = items[k // 2], items[k // 2][1].split()
        if k % 2:  # a paraphrase: every eighth word replaced
            words = [w if j % 8 else "paraphrase" for j, w in enumerate(words)]
        docs[k] = (k, f"{docs[k][1]} {' '.join(words).upper()} {story(rng, 50)}")
        planted.add((k, item[0]))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1])]
    planted.add((202, 0))
    got = contaminated(
        spark.createDataFrame(docs, TWO).selectExpr("*", "1 as item_id", "2 as id"),
        spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)


def test_long_items_are_found(spark):
    """Items longer than any one passage length, as copies and with a third of the words replaced."""
    rng = random.Random(12)
    items = [(k, story(rng, n) + ". " + story(rng, 4)) for k, n in enumerate([20, 55, 59, 63, 64, 100, 127, 128, 200, 300, 600, 2500])]
    docs, planted = [(1000 + k, story(rng, 300)) for k in range(40)], set()
    for k, text in items:
        words = text.split()
        loose = [w if j % 3 or j >= len(words) - 4 else "paraphrase" for j, w in enumerate(words)]
        docs += [(2 * k, f"{story(rng, 75)} {text} {story(rng, 90)}"), (2 * k + 1, f"{story(rng, 41)} {' '.join(loose)} {story(rng, 60)}")]
        planted |= {(2 * k, k), (2 * k + 1, k)}
    got = contaminated(spark.createDataFrame(docs, TWO), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted


def test_items_in_blocks(spark, monkeypatch):
    from paxflow.llm import decontaminate

    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 4)
    rng = random.Random(3)
    items = [(k, story(rng, 30)) for k in range(10)]
    docs = [(k, f"{story(rng, 60)} {t} {story(rng, 20)}") for k, t in items] + [(50, story(rng, 100))]
    got = contaminated(spark.createDataFrame(docs, TWO), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(k, k) for k in range(10)}


def test_pipeline_keeps_columns_and_rereads_each_stage(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns, name
    out = cp.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_items_and_documents_without_ids(spark):
    rng = random.Random(10)
    items = [(None, story(rng, 30)), (None, None), (4, story(rng, 30)), (4, ""), (5, None)]
    docs = [(None, story(rng, 20) + " " + items[0][1] + " " + story(rng, 20)), (1, items[2][1]), (2, story(rng, 60)), (None, None), (3, "")]
    found = contaminated(spark.createDataFrame(docs, TWO), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(None, None), (1, 4)}
