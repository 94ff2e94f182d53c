"""Places in a global order without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxflow.plans.sizing import stored


def with_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` plus ``name``: each row's place, from 1, in the order given.

    Rows are dealt by ranges and sorted inside them; a range then needs only
    the number of rows before it, one figure per range. Each range is written
    once, so its rows and their places cannot change between the two reads.
    """
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", inside), "order")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range, so the window is as small as the number of ranges
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    placed = parts.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1)
    return placed.drop("_part", "_at", "_before")
