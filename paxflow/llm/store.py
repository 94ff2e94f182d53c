"""Running totals over tables too large to sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxflow.plans.sizing import stored

WORD = r"[^\x20\x09-\x0D]+"


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` plus ``name``: the sum of ``value`` over all rows before each
    row in the order given, without sorting everything in one task.

    Rows are range-partitioned and stored with their partition number;
    partition sums (one row per partition) give each partition's offset.
    """
    parts = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()),
        "order",
    )
    sums = parts.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_offset")
    )
