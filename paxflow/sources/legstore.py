"""Intermediate storage of the passenger-leg table as Parquet.

Legs are written once, partitioned by UTC departure month and sorted by
leg key inside each file (output balanced by AQE, so a hot month or key
is split over several files), so a date range prunes whole directories and
the remaining predicates (exact departure range, origin set) reach the
Parquet reader as pushed filters with row-group statistics. The latest
status is then computed only over the months that can match; because
the departure instant is part of the leg key, a month holds complete
latest-status groups and pruning never changes a result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.functions.instants import departure_window
from paxflow.schema import LEG_KEY

PARTITION = "departure_month"


def write_leg_store(legs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write legs partitioned by departure month (DATE, first of month).

    ``overwrite`` uses dynamic partition overwrite when the session sets
    ``spark.sql.sources.partitionOverwriteMode=dynamic``; appending a day
    of new events only touches the months it contains.
    """
    month = F.trunc(F.col("departure_ts").cast("date"), "month")
    # ``rebalance`` groups rows by month but lets AQE split a hot month (or
    # a hot key) over several tasks and files instead of one.
    (
        legs.withColumn(PARTITION, month)
        .hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, *LEG_KEY)
        .write.mode(mode)
        .partitionBy(PARTITION)
        .parquet(path)
    )


def read_leg_store(
    spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None, origins=None
) -> DataFrame:
    """Legs of the store whose departure date lies in [start, end]."""
    legs = spark.read.parquet(path)
    cond = departure_window("departure_ts", start, end)
    if start is not None:
        cond = cond & (F.col(PARTITION) >= F.lit(start.replace(day=1)))
    if end is not None:
        cond = cond & (F.col(PARTITION) <= F.lit(end.replace(day=1)))
    if origins is not None:
        cond = cond & F.col("origin_airport").isin(*origins)
    return legs.filter(cond).drop(PARTITION)

