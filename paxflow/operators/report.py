"""Passenger report and its orderings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paxflow.config import ADULT, CHILD
from paxflow.functions.instants import departure_window
from paxflow.schema import REPORT_GROUP


def passenger_report(enriched: DataFrame) -> DataFrame:
    """A2: per (country, day_of_week, season): passenger-legs, adults,
    children and average age.

    Input rows are unique passenger-legs (after latest status), so plain
    counts are exact distinct counts: one hash aggregate with partial
    aggregation, no Expand. Other passenger types count only in the total.
    """
    age = F.col("passenger_age").cast("bigint")
    return enriched.groupBy(*REPORT_GROUP).agg(
        F.count(F.lit(1)).alias("passenger_count"),
        F.count_if(F.col("passenger_type") == ADULT).alias("adults_count"),
        F.count_if(F.col("passenger_type") == CHILD).alias("children_count"),
        F.sum(age).alias("_age_sum"),
        F.count(age).alias("_age_n"),
    ).select(
        *REPORT_GROUP,
        "passenger_count",
        "adults_count",
        "children_count",
        _rounded_avg("_age_sum", "_age_n").alias("average_age"),
    )


def _rounded_avg(total: str, n: str) -> Column:
    """Average rounded half up to hundredths, computed exactly with
    integer arithmetic and one final IEEE division by 100, so no x.xx5
    value is rounded the binary way; null when there is no age. (Ages are
    non-negative; ``div`` truncates, which is half-up for them.)"""
    return F.expr(f"CASE WHEN {n} > 0 THEN CAST(({total} * 200 + {n}) div ({n} * 2) AS DOUBLE) / 100 END")


def report_rows(report: DataFrame) -> DataFrame:
    """Report projection: zero adult/child counts become null, the
    average stays as computed (0.0 stays 0.0)."""
    return report.select(
        *REPORT_GROUP,
        "passenger_count",
        F.nullif(F.col("adults_count"), F.lit(0)).alias("adults_count"),
        F.nullif(F.col("children_count"), F.lit(0)).alias("children_count"),
        "average_age",
    )


def report_order() -> list[Column]:
    """O1: passenger_count desc, season, day name, country (total order)."""
    return [
        F.col("passenger_count").desc(),
        F.col("season").asc(),
        F.col("day_of_week").asc(),
        F.col("country").asc(),
    ]


def order_report(report: DataFrame) -> DataFrame:
    return report.orderBy(*report_order())


def top_n(report: DataFrame, n: int = 10) -> DataFrame:
    """O2: first ``n`` rows of the ordered report (TakeOrderedAndProject)."""
    return report.orderBy(*report_order()).limit(n)


def rank_within_season_day(report: DataFrame, k: int | None = None) -> DataFrame:
    """Rank countries by passengers inside each (season, day_of_week);
    ties share a rank. ``k`` keeps ranks <= k."""
    w = Window.partitionBy("season", "day_of_week").orderBy(F.col("passenger_count").desc())
    ranked = report.withColumn("rank", F.rank().over(w))
    return ranked.filter(F.col("rank") <= k) if k is not None else ranked


def day_country_counts(enriched: DataFrame, day: dt.date, distinct: bool = True) -> DataFrame:
    """A6/ST6: passengers per destination country for one UTC departure day.

    ``distinct=True`` expects unique passenger-legs (after latest status);
    ``distinct=False`` counts every qualifying row as it comes.
    """
    rows = enriched.filter(departure_window("departure_ts", day, day))
    if distinct:
        rows = rows.dropDuplicates(["passenger_uci", "origin_airport", "destination_airport", "departure_ts"])
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("passengers"))


def top_countries(counts: DataFrame, n: int = 10, by: str = "passengers") -> DataFrame:
    """O3: top ``n`` countries by count (country breaks ties)."""
    return counts.orderBy(F.col(by).desc(), F.col("country").asc()).limit(n)


def daily_country_counts(enriched: DataFrame) -> DataFrame:
    """A7/ST4: tumbling one-day windows (UTC) of departures per country."""
    return (
        enriched.groupBy(F.window("departure_ts", "1 day").alias("w"), "country")
        .agg(F.count(F.lit(1)).alias("bookings"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "country",
            "bookings",
        )
    )


def top_country_per_day(enriched: DataFrame) -> DataFrame:
    """ST7 batch form: for every UTC departure day the country (or tied
    countries) with the most passengers."""
    counts = (
        enriched.groupBy(F.col("departure_ts").cast("date").alias("departure_day"), "country")
        .agg(F.count(F.lit(1)).alias("passengers"))
    )
    w = Window.partitionBy("departure_day").orderBy(F.col("passengers").desc())
    return counts.withColumn("rank", F.rank().over(w)).filter(F.col("rank") == 1).drop("rank")
