"""Exact duplicates through an extendible-hash index on shared files.

Every text gets a 64-bit key. The index holds one entry per distinct key in
buckets named by the key's leading bits; the directory doubles (one more
bit) until no bucket holds more than ``capacity`` keys, so a bucket is a key
range. The index tells which keys are met more than once and whose they are;
texts of other keys are never moved. Copies are combined by comparing their
bytes, and the task that owns a bucket links what is left of a key into its
chain, one slot per distinct text, against which rows are looked up.

Only DataFrame functions. Counts are combined before every shuffle, so a
text held by a third of all rows reaches its owner as one row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.plans.sizing import bounded_broadcast, stored

# Keys of a bucket: a page of about 100 KB.
BUCKET_CAPACITY = 1 << 12
# Key and id pairs up to this many rows (24 bytes each, 24 MB) may be sent to every task.
SMALL_SIDE_ROWS = 1_000_000


def text_key(text: Column, key_bits: int = 64) -> Column:
    """The leading ``key_bits`` bits of the text's hash, as a long."""
    key = F.xxhash64(text)
    if key_bits >= 64:
        return key
    return F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)


def extendible_index(entries: DataFrame, capacity: int = BUCKET_CAPACITY, key_bits: int = 64) -> DataFrame:
    """``entries`` (distinct ``key``) plus ``bucket`` and ``depth``, sorted by key in range-owned files.

    The directory starts at the last depth at which the keys cannot all fit
    and doubles while some bucket is overfull; buckets that fit keep their
    own (local) depth. Buckets of the full key length may stay overfull.
    """
    n = entries.count()
    depth = min(key_bits, max(1, math.floor(math.log2(n / capacity)) if n > capacity else 1))
    left, settled = entries.select("key"), []
    while True:
        slot = F.shiftrightunsigned("key", 64 - depth)
        counts = left.groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).withColumn("depth", F.lit(depth))
        if depth == key_bits:
            settled.append(counts)
            break
        full = F.col("n") > capacity
        settled.append(counts.filter(~full))
        over = counts.filter(full).select("slot")
        if over.isEmpty():
            break
        left = stored(left.withColumn("slot", slot).join(over, "slot", "left_semi").drop("slot"), "overfull")
        depth += 1
    buckets = settled[0]
    for more in settled[1:]:
        buckets = buckets.unionByName(more)
    # Each bucket of a smaller depth owns several directory slots.
    directory = buckets.select(
        F.explode(F.expr(f"sequence(shiftleft(slot, {depth} - depth), shiftleft(slot + 1, {depth} - depth) - 1)")).alias("slot"),
        F.expr(f"shiftleft(slot, {depth} - depth)").alias("bucket"),
        "depth",
    )
    index = entries.withColumn("slot", F.shiftrightunsigned("key", 64 - depth)).join(directory, "slot").drop("slot")
    return stored(index.repartitionByRange("key").sortWithinPartitions("key"), "index")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = BUCKET_CAPACITY,
    key_bits: int = 64,
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Rows with equal texts form a group; the largest id of the group stays.
    A null text counts as empty. A null id loses against any other id and
    stays only where the whole group has none. Rows that repeat both id and
    text are all marked like their one id. Other columns are ignored; an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("key", text_key(F.col("text"), key_bits))
    postings = stored(rows.select("id", "key", F.unhex(F.sha2("text", 256)).alias("sha")), "postings")
    entries = postings.groupBy("key").agg(F.count("*").alias("n"))
    index = extendible_index(stored(entries, "entries"), capacity, key_bits)

    repeated = index.filter("n > 1").select("key", "bucket")
    # Copies: grouping by the text compares it byte by byte.
    texts = (
        rows.join(bounded_broadcast(repeated, SMALL_SIDE_ROWS), "key")
        .groupBy("bucket", "key", "text")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("bucket", "key", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size")
    )
    # Chains: a bucket has one owner, which gives each text of a key its slot.
    slots = (
        texts.repartition("bucket")
        .groupBy("bucket", "key", "sha")
        .agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count("*").alias("texts"),
        )
    )
    chains = stored(
        slots.filter("group_size > 1 or texts > 1").select(
            F.col("key").alias("k"),
            F.col("sha").alias("s"),
            "keep_id",
            F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share key and SHA-256")).cast("long"))
            .otherwise(F.col("group_size"))
            .alias("group_size"),
        ),
        "chains",
    )
    found = postings.join(
        bounded_broadcast(chains, SMALL_SIDE_ROWS), (F.col("key") == F.col("k")) & (F.col("sha") == F.col("s")), "left"
    )
    keep = F.when(F.col("s").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
