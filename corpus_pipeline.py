"""Training-corpus pipeline: five stages over the ``documents`` table.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet to the shared folder and reads it again as the
next stage's documents. All stages but the last return the columns of
``documents``, extra ones included, whatever their names. An empty table goes
through all stages as one.

Decisions are taken per document and joined back by ``doc_id`` where ids are
there and differ. Where some are null or repeated, a hash of the document's
columns takes their place, so that no row is judged by another's id; rows
that are equal in all columns are then one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.llm.decontaminate import contaminated
from paxflow.llm.mixing import mix_plan
from paxflow.llm.ngram_join import jaccard_components
from paxflow.llm.queries import tokenizer_file
from paxflow.llm.token_store import token_digests
from paxflow.llm.toxicity import score_texts, train
from paxflow.plans.sizing import bounded_broadcast, shared_dir

REJECT_SCORE = 0.5
# Id lists of up to this many rows (16 bytes each) may be sent to every task; longer ones are joined by shuffle.
SMALL_LIST = 1_000_000

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` is called that in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def document_hash() -> Column:
    """64 bits of a document's columns; nulls count as such."""
    return F.xxhash64(*[c for name in DOCUMENT for c in (F.col(name), F.col(name).isNull())])


def with_key(docs: DataFrame) -> tuple[DataFrame, str, bool]:
    """(``docs`` plus a bigint key, the key's name, whether rows may share
    one): the id where all ids are there and differ, else the document's hash."""
    key = unused(docs, "row_key")
    unclear = docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").limit(1).count()
    return docs.withColumn(key, document_hash() if unclear else F.col("doc_id").cast("long")), key, bool(unclear)


def once(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with rows that share a key once. Only such rows are shuffled,
    and tasks combine theirs first."""
    again = docs.groupBy(key).count().filter("count > 1").select(F.col(key).alias("again"))
    again = bounded_broadcast(again, SMALL_LIST)
    single = docs.join(again, docs[key] == again["again"], "left_anti")
    return single.unionByName(docs.join(again, docs[key] == again["again"], "left_semi").dropDuplicates([key]))


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``docs`` whose key is not among the only column of ``gone``, without the key."""
    listed = bounded_broadcast(gone.toDF("gone"), SMALL_LIST)
    kept = docs.join(listed, docs[key] == listed["gone"], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns if c != key])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, each row by its own text.

    Null and empty texts are scored like any other; labels are found by id,
    so rows without one train nothing. Repeated rows share their fate. A
    column called like the score keeps its name and values.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clash = [c for c in docs.columns if c.lower() == "score"]
    away = {c: unused(docs, f"own_{c}") for c in clash}
    scored = score_texts(docs.withColumnsRenamed(away), model).filter(F.col("score") < REJECT_SCORE)
    return scored.drop("score").withColumnsRenamed({v: k for k, v in away.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one with the
    smallest key, which is its id where ids are there and differ. Null and
    empty texts link with nothing and stay; of equal rows one stays."""
    keyed, key, shared = with_key(docs)
    keyed = once(keyed, key) if shared else keyed
    groups = jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("id"), "component_id")
    return without(keyed, key, groups.distinct().filter("id <> component_id").select("id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, rows without an id among them.
    Null and empty texts hold none; equal rows go or stay together."""
    keyed, key, _ = with_key(docs)
    found = contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(keyed, key, found.select("doc_id").distinct())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Rows that share an id are
    mixed each by itself; equal rows are taken as often as all of them
    together. Null and empty texts have size 0 and are never the fraction of
    a source that is added; a null source is a source of its own."""
    keyed, key, shared = with_key(docs)
    plan = mix_plan(keyed.select(F.col(key).alias("doc_id"), "text", "source")).groupBy("doc_id")
    plan = plan.agg((F.sum if shared else F.max)("epochs").cast("int").alias("times")).filter("times > 0")
    taken = bounded_broadcast(plan.select(F.col("doc_id").alias("taken_key"), "times"), SMALL_LIST)
    keyed = once(keyed, key) if shared else keyed
    joined = keyed.join(taken, keyed[key] == taken["taken_key"])
    own = [keyed[f"`{c}`"] for c in docs.columns]
    turn = unused(docs, "turn")
    return joined.select(*own, F.explode(F.sequence(F.lit(1), taken["times"])).alias(turn)).drop(turn)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back by key: doc_id, start, n_tokens,
    ids_crc32, one row per document taken. Null and empty texts are an end id."""
    return token_digests(docs, tokenizer_file())


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_id_output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


# Compression distances, latent retrieval and token ids have no SQL form.
ORACLE_SQL = None
