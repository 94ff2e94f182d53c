"""Enrichment: destination country, local day of week, season (E1-E4,
J1, J2, F12) and airport existence reports (J4, Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paxflow.functions.instants import local_day_name, season_of
from paxflow.plans.sizing import bounded_broadcast


def zone_columns(airports: DataFrame) -> DataFrame:
    return airports.select("iata", "country", "tz")


def enrich(legs: DataFrame, airports: DataFrame, tz_from: str = "origin") -> DataFrame:
    """Add country, day_of_week and season; legs whose destination has no
    (non-empty) country are dropped.

    ``tz_from="origin"``: the origin airport's zone, else the destination's
    when the origin is unknown or its zone is empty, else UTC.
    ``tz_from="destination"``: the destination's zone, else UTC.
    Season comes from the UTC month of departure. The dimension is
    broadcast behind a row-count check (a job when this is called). Both
    lookups read the same columns of it with the same filters, so one
    computed and broadcast table serves both.
    """
    dim = bounded_broadcast(zone_columns(airports))
    d, o = dim.alias("_d"), dim.alias("_o")
    # Written on both sides of the join: on the airport alone the test would
    # be pushed into this lookup's table, and the other could not share it.
    country = F.when(F.col("destination_airport").isNotNull(), F.col("_d.country"))
    out = legs.join(d, F.col("destination_airport") == F.col("_d.iata"), "inner").filter(country != "")
    if tz_from == "origin":
        # As an expression the key passes no origin rule on to the table, for the same reason; '' is no airport's code.
        out = out.join(o, F.coalesce("origin_airport", F.lit("")) == F.col("_o.iata"), "left")
        # a known airport's country is never null; reading it keeps the columns of both lookups alike
        origin_zone = F.when(F.col("_o.country").isNotNull(), F.nullif(F.col("_o.tz"), F.lit("")))
        zone = F.coalesce(origin_zone, F.nullif(F.col("_d.tz"), F.lit("")), F.lit("UTC"))
    else:
        zone = F.coalesce(F.nullif(F.col("_d.tz"), F.lit("")), F.lit("UTC"))
    return out.select(
        *[F.col(c) for c in legs.columns],
        F.col("_d.country").alias("country"),
        local_day_name("departure_ts", zone).alias("day_of_week"),
        season_of("departure_ts").alias("season"),
    )


def unknown_destinations(legs: DataFrame, airports: DataFrame) -> DataFrame:
    """Destinations with no country, with their leg counts."""
    known = bounded_broadcast(airports.filter(F.col("country") != "").select("iata"))
    return (
        legs.join(known, F.col("destination_airport") == F.col("iata"), "left_anti")
        .groupBy("destination_airport")
        .agg(F.count(F.lit(1)).alias("legs"))
    )


def known_destinations(legs: DataFrame, airports: DataFrame) -> DataFrame:
    """Legs whose destination exists in the dimension."""
    known = bounded_broadcast(airports.select("iata"))
    return legs.join(known, F.col("destination_airport") == F.col("iata"), "left_semi")
