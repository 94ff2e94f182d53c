"""The canonical batch plan, as one chain of DataFrames. It is lazy but for
the row count of the airport dimension, a small job when the chain is built.

lines -> events -> legs (key predicates inside the flatten) -> latest
status -> rules -> enrichment -> report. Two wide shuffles (leg key,
report group); the airport dimension is broadcast behind a size check.
Stage row counts come from ``DataFrame.observe`` in the same job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paxflow.config import RuleConfig
from paxflow.operators.enrich import enrich
from paxflow.operators.report import passenger_report, report_rows
from paxflow.operators.rules import apply_rules
from paxflow.plans.sizing import stored
from paxflow.sources.airports import read_airports
from paxflow.sources.bookings import explode_legs, feed_legs, parse_events, product_key_filter, read_booking_events


def rule_legs(lines: DataFrame, cfg: RuleConfig) -> DataFrame:
    # ``lines``: a decoded JSON scan (read_booking_events) or raw lines.
    """Passenger-legs that can pass the key rules (origin, date).

    The predicates sit on product rows, before passengers are joined to them;
    they touch only key columns, so whole latest-status groups are kept or
    dropped and the result equals filtering after the window.
    """
    return feed_legs(lines, cfg.strict, cfg.origins, cfg.start, cfg.end)


def report_from_legs(legs: DataFrame, airports: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Core report (counts kept as 0, numeric average)."""
    return passenger_report(enrich(apply_rules(legs, cfg), airports, cfg.tz_from))


def report_from_lines(lines: DataFrame, airports: DataFrame, cfg: RuleConfig) -> DataFrame:
    return report_from_legs(rule_legs(lines, cfg), airports, cfg)


@dataclass
class StageCounts:
    observations: dict

    def get(self) -> dict:
        """Row counts per stage; available once the report has been
        computed by an action (same job, no extra scans)."""
        return {name: obs.get["rows"] for name, obs in self.observations.items()}


def observed_report(lines: DataFrame, airports: DataFrame, cfg: RuleConfig) -> tuple[DataFrame, StageCounts]:
    """Q1: the ordered report rows plus stage row counts gathered with
    ``observe`` in the same job (no extra scans or count() actions).

    The last observation sits above the sort: the sort's sampling job
    re-reads the aggregate's shuffle output, and an observation below it
    would count those rows twice.
    """
    from paxflow.operators.report import order_report
    obs = {name: Observation(name) for name in ("events", "legs", "latest_confirmed", "enriched", "groups")}

    def watch(df: DataFrame, name: str) -> DataFrame:
        return df.observe(obs[name], F.count(F.lit(1)).alias("rows"))

    events = watch(parse_events(lines, strict=cfg.strict), "events")
    legs = watch(explode_legs(events, product_filter=product_key_filter(cfg.origins, cfg.start, cfg.end)), "legs")
    kept = watch(apply_rules(legs, cfg), "latest_confirmed")
    enriched = watch(enrich(kept, airports, cfg.tz_from), "enriched")
    report = watch(order_report(report_rows(passenger_report(enriched))), "groups")
    return report, StageCounts(obs)


def run_report(
    spark: SparkSession,
    bookings_path,
    airports_path,
    cfg: RuleConfig,
    glob: str | None = "*.json",
) -> DataFrame:
    """Batch entry: booking files + airport file -> ordered report rows."""
    lines = read_booking_events(spark, bookings_path, glob=glob)
    # parsed once for the size check and both lookups
    airports = stored(read_airports(spark, airports_path), "airports")
    from paxflow.operators.report import order_report

    return order_report(report_rows(report_from_lines(lines, airports, cfg)))
