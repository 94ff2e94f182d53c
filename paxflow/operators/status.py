"""Latest booking status per passenger-leg.

The leg key is (passenger_uci, origin_airport, destination_airport,
departure_ts); the airline is not part of it. The newest booking event
wins; on equal timestamps ``cancelled_first`` lets the alphabetically
first status win (CANCELLED before CONFIRMED), ``confirmed_first`` lets
CONFIRMED win. The remaining columns complete a total order so the
result never depends on input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxflow.config import CONFIRMED
from paxflow.schema import LEG_KEY


def _order(tie_break: str) -> list[Column]:
    status_rank = (
        [F.when(F.col("booking_status") == CONFIRMED, 0).otherwise(1).asc()]
        if tie_break == "confirmed_first"
        else []
    )
    return [
        F.col("booking_ts").desc_nulls_last(),
        *status_rank,
        F.col("booking_status").asc_nulls_first(),
        F.col("operating_airline").asc_nulls_last(),
        F.col("arrival_ts").asc_nulls_last(),
        F.col("passenger_type").asc_nulls_last(),
        F.col("passenger_age").asc_nulls_last(),
    ]


def latest_status(legs: DataFrame, tie_break: str = "cancelled_first") -> DataFrame:
    """One row per leg key: its latest event, plus ``is_confirmed``.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before
    the shuffle, so a hot key is cut to one row per map task first.
    Predicates on key columns placed above this operator are pushed below
    the window (and into a Parquet scan) by Catalyst.
    """
    w = Window.partitionBy(*LEG_KEY).orderBy(*_order(tie_break))
    return (
        legs.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
        .withColumn("is_confirmed", F.col("booking_status") == CONFIRMED)
    )


def order_struct(tie_break: str = "cancelled_first") -> Column:
    """Struct whose minimum is the latest event under the tie rule.

    Used by the aggregate form (streaming state, bench comparison):
    newest first via negated epoch micros, then the same tie columns.
    """
    # Epoch micros of the UTC wall clock, negated: newest first, null last.
    neg_ts = F.coalesce(
        -F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("booking_ts")),
        F.lit(2**63 - 1),
    )
    fields = [neg_ts.alias("t")]
    if tie_break == "confirmed_first":
        fields.append(F.when(F.col("booking_status") == CONFIRMED, 0).otherwise(1).alias("c"))
    fields += [
        F.col("booking_status").alias("s"),
        F.coalesce(F.col("operating_airline"), F.lit("￿")).alias("a"),
        F.col("arrival_ts").alias("r"),
        F.coalesce(F.col("passenger_type"), F.lit("￿")).alias("p"),
        F.coalesce(F.col("passenger_age"), F.lit(2**31 - 1)).alias("g"),
    ]
    return F.struct(*fields)


def latest_status_agg(legs: DataFrame, tie_break: str = "cancelled_first") -> DataFrame:
    """Aggregate form of :func:`latest_status` (``min_by`` per key).

    Works on streams (windows with row_number do not) and does partial
    aggregation before the shuffle.
    """
    payload = [c for c in legs.columns if c not in LEG_KEY]
    return (
        legs.groupBy(*LEG_KEY)
        .agg(F.min_by(F.struct(*payload), order_struct(tie_break)).alias("_l"))
        .select(*LEG_KEY, "_l.*")
        .withColumn("is_confirmed", F.col("booking_status") == CONFIRMED)
    )
