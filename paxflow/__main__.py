"""Command line: ``python -m paxflow ...`` or, on a cluster,
``spark-submit --py-files paxflow.zip paxflow/__main__.py ...``.

Batch report (default), one-day top countries (``--day``) or the
continuous stream (``--stream``). With more outputs than the report
(``--quarantine``, ``--unknown-airports``, ``--skip-unreadable``) the feed is
parsed once and all of them read its stored outcomes. The caller's Spark configuration
(master, memory, checkpoint folder) is used as given.
"""

from __future__ import annotations

import argparse
import datetime as dt

from paxflow.config import DEFAULT_AIRLINE, DEFAULT_ORIGINS, RuleConfig, parse_codes


def _day(text: str) -> dt.date:
    if text == "today":
        return dt.datetime.now(dt.timezone.utc).date()
    return dt.date.fromisoformat(text)


def _args(argv=None):
    p = argparse.ArgumentParser(prog="paxflow", description="Passenger report per country, day of week and season")
    p.add_argument("--bookings", required=True, help="booking file or directory (any Hadoop URI)")
    p.add_argument("--airports", required=True, help="airport CSV file or directory")
    p.add_argument("--output", help="report path; .json -> JSON lines, else CSV")
    p.add_argument("--start-date", type=dt.date.fromisoformat)
    p.add_argument("--end-date", type=dt.date.fromisoformat)
    p.add_argument("--airline", default=DEFAULT_AIRLINE)
    p.add_argument("--origins", default=",".join(DEFAULT_ORIGINS), help="comma separated IATA codes")
    p.add_argument("--origin-country", help="take origins from the airport file by country instead")
    p.add_argument("--tz-from", choices=("origin", "destination"), default="origin")
    p.add_argument("--tie-break", choices=("cancelled_first", "confirmed_first"), default="cancelled_first")
    p.add_argument("--strict", action="store_true", help="drop a whole event when any member is invalid")
    p.add_argument("--glob", default="*.json", help="file name filter inside directories ('' for all)")
    p.add_argument("--quarantine", help="append rejected events and legs with a reason to this path")
    p.add_argument("--skip-unreadable", action="store_true", help="go on when a booking file cannot be read, and name it")
    p.add_argument("--unknown-airports", help="write destinations without a country (with leg counts) here")
    p.add_argument("--day", type=_day, help="top countries of one UTC departure day ('today' allowed)")
    p.add_argument("--stream", action="store_true", help="run continuously over new booking files")
    p.add_argument("--state", help="folder of the stream's ledger and checkpoint (default under spark.checkpoint.dir)")
    p.add_argument("--trigger", default="10 seconds", help="how often the stream takes new files")
    p.add_argument("--available-now", action="store_true", help="take in the files that are there, then stop")
    p.add_argument("--files-per-trigger", type=int, default=10)
    p.add_argument("--daily-counts", choices=("console", "table"),
                   help="stream bookings per day and country as they come (no retraction) instead of the ledger")
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--spark-ui", action="store_true", help="start Spark's web UI (off by default)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from paxflow.operators.enrich import enrich, unknown_destinations
    from paxflow.operators.report import day_country_counts, order_report, report_rows, top_countries
    from paxflow.operators.rules import apply_rules, departing_from
    from paxflow.plans.pipeline import observed_report, report_from_legs, rule_legs
    from paxflow.plans.sizing import stored
    from paxflow.sources.airports import country_airports, read_airports
    from paxflow.sources.bookings import read_booking_events
    from paxflow.sources.ingest import booking_files, ingest_files
    from paxflow.sources.sinks import read_report, write_quarantine, write_report

    a = _args(argv)
    builder = SparkSession.builder.appName("paxflow")
    if not a.spark_ui:
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    airports = stored(read_airports(spark, a.airports), "airports")
    # --origin-country: origins come from the airport data through a semi
    # join (broadcast behind a size check), never through the driver.
    origins = None if a.origin_country else parse_codes(a.origins)
    cfg = RuleConfig(
        start=a.start_date, end=a.end_date, airline=a.airline, origins=origins,
        tz_from=a.tz_from, tie_break=a.tie_break, strict=a.strict,
    )
    glob = a.glob or None

    if a.stream:
        _stream(spark, a, cfg, glob, airports)
        return

    stored_feed = None
    if a.quarantine or a.unknown_airports or a.skip_unreadable:
        stored_feed = ingest_files(spark, a.bookings, glob, cfg.strict, a.skip_unreadable)
    if a.skip_unreadable:
        skipped = stored_feed.skipped(booking_files(spark, a.bookings, glob))
        print("unreadable files:")
        skipped.orderBy("file").show(a.top, truncate=False)
    if a.quarantine:
        rejects = stored_feed.rejects()
        if a.skip_unreadable:
            unread = skipped.select(F.col("file").alias("value"), F.lit("unreadable_file").alias("reason"), F.lit("file").alias("level"))
            rejects = rejects.unionByName(unread, allowMissingColumns=True)
        write_quarantine(rejects, a.quarantine)
    if a.unknown_airports:
        unknown = unknown_destinations(stored_feed.legs(), airports)
        unknown.write.mode("overwrite").option("header", True).csv(a.unknown_airports)

    def legs_for(rules: RuleConfig):
        """Legs that the rules' origins and dates leave: from the stored outcomes, or straight from the feed."""
        if stored_feed is not None:
            return stored_feed.legs(rules.start, rules.end)
        return rule_legs(read_booking_events(spark, a.bookings, glob=glob), rules)

    if a.day:
        day_cfg = cfg.with_(start=a.day, end=a.day)
        enriched = enrich(apply_rules(legs_for(day_cfg), day_cfg), airports, cfg.tz_from)
        top_countries(day_country_counts(enriched, a.day), n=a.top).show(a.top, truncate=False)
        return
    counts = None
    if a.origin_country:
        legs = departing_from(legs_for(cfg), country_airports(airports, a.origin_country))
        report = order_report(report_rows(report_from_legs(legs, airports, cfg)))
    elif stored_feed is not None:
        report = order_report(report_rows(report_from_legs(legs_for(cfg), airports, cfg)))
    else:
        report, counts = observed_report(read_booking_events(spark, a.bookings, glob=glob), airports, cfg)
    shown = report
    if a.output:
        # one job computes and writes the report; the summary then reads
        # the small written file instead of recomputing the plan
        write_report(report, a.output)
        shown = order_report(read_report(spark, a.output))
    shown.limit(a.top).show(a.top, truncate=False)
    if counts is not None:
        print("rows per stage:", counts.get())
    if stored_feed is not None:
        print("outcomes of the feed:")
        stored_feed.counts().orderBy("outcome", "reason").show(100, truncate=False)


def _stream(spark, a, cfg: RuleConfig, glob: str | None, airports) -> None:
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.airports import read_airports
    from paxflow.streaming import stream as st
    from paxflow.streaming.ledger import Ledger, show_top

    base = a.state or shared_dir(spark, "stream")
    lines = st.stream_lines(spark, a.bookings, a.files_per_trigger, glob=glob)
    if a.daily_counts:
        counts = st.daily_counts_stream(st.stream_legs(lines), airports, cfg)
        console = a.daily_counts == "console"
        query = st.start_daily_counts(
            counts, f"{base}/daily", f"{base}/daily-checkpoint", a.available_now, console=console, processing_time=a.trigger
        )
        print("bookings per day and country:", "console" if console else f"{base}/daily")
    else:
        ledger = Ledger(spark, f"{base}/ledger", cfg)
        # the airport file is read anew for every view: a new airport shows without a restart
        show = show_top(ledger, lambda: read_airports(spark, a.airports), a.top)
        query = ledger.start(st.stream_legs(lines, cfg), f"{base}/checkpoint", a.available_now, a.trigger, after_batch=show)
        print(f"ledger: {base}/ledger  (read it with paxflow.streaming.ledger.Ledger)")
    query.awaitTermination()


if __name__ == "__main__":
    main()
