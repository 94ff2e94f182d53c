"""Broadcast only behind a size check; storage for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows above which a dimension is joined by shuffle instead of broadcast.
# The deduplicated airport dimension has one row per IATA code (at most
# 26**3 = 17 576 three-letter codes); the bound leaves room for odd codes.
BROADCAST_MAX_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only when ``df`` has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows of the (small) side.
    Beyond the bound the join stays a shuffle join and AQE may still turn
    it into a broadcast from runtime statistics.
    """
    if df.isStreaming:
        return df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint location, also registered as the
    SparkContext checkpoint folder so ``DataFrame.checkpoint()`` works.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a
    ``local[...]`` session (driver and executors are one process) gets a
    folder of its own; on a cluster a missing setting is an error, because
    no machine-local folder is visible to every executor.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"/tmp/paxflow-{sc.applicationId}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder: cuts lineage,
    survives executor loss, and readers prune its columns and push filters
    into it (a checkpointed RDD allows neither)."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_base(spark).rstrip('/')}/paxflow/{purpose}-{uuid.uuid4().hex}"
