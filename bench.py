#!/usr/bin/env python
"""Benchmark: headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS].

Input set-up (not timed): the booking feed derived from the tables is
written once as JSON-lines files and the airport dimension as a CSV file
under the session's checkpoint folder; the legs are also stored as
Parquet partitioned by departure month. Each case then runs end to end
from those files (warm session, median of $BENCH_REPS runs, one warm-up).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "5"))

HEADLINE = ("passenger_report", "parse_legs", "latest_status", "event_rules", "legs_parquet_report", "stream_top_countries")


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("paxflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * CPUS)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(fn, reps=REPS, warmup=1):
    for _ in range(warmup):
        fn()
    runs = []
    for _ in range(reps):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def reference_style_report(spark, lines_dir, airports_dir, cfg):
    """Comparison plan written the way the original DataFrame mode does it:
    date_format partition key, count() per stage, two row-at-a-time Python
    UDFs (season, zone day) and three distinct counts on a string key."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    from paxflow.sources.airports import read_airports
    from paxflow.sources.bookings import explode_legs, parse_events, read_booking_events

    legs = explode_legs(parse_events(read_booking_events(spark, lines_dir)))
    legs.count()
    w = Window.partitionBy(
        "passenger_uci", "origin_airport", "destination_airport",
        F.date_format("departure_ts", "yyyy-MM-dd'T'HH:mm:ss"),
    ).orderBy(F.col("booking_ts").desc(), F.col("booking_status"))
    latest = legs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").cache()
    latest.count()
    kept = latest.filter(F.col("booking_status") == "CONFIRMED")
    kept.count()
    kept = kept.filter(
        (F.to_date("departure_ts") >= F.lit(str(cfg.start))) & (F.to_date("departure_ts") <= F.lit(str(cfg.end)))
    )
    kept.count()
    kept = kept.filter(F.col("operating_airline") == cfg.airline)
    kept.count()
    kept = kept.filter(F.col("origin_airport").isin(*cfg.origins))
    kept.count()
    airports = read_airports(spark, airports_dir)
    zones = {r.iata: r.tz for r in airports.select("iata", "tz").collect()}

    @F.udf(StringType())
    def season(ts):
        m = ts.month
        return "Winter" if m in (12, 1, 2) else "Spring" if m < 6 else "Summer" if m < 9 else "Fall"

    @F.udf(StringType())
    def day_name(ts, dest):
        from zoneinfo import ZoneInfo

        z = zones.get(dest) or "UTC"
        try:
            return ts.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(z)).strftime("%A")
        except Exception:  # noqa: BLE001
            return ts.strftime("%A")

    from paxflow.plans.sizing import bounded_broadcast

    enriched = kept.join(
        bounded_broadcast(airports.select(F.col("iata").alias("d"), "country")), F.col("destination_airport") == F.col("d")
    ).withColumn("season", season("departure_ts")).withColumn("day_of_week", day_name("departure_ts", "destination_airport"))
    enriched.count()
    key = F.concat_ws("_", "passenger_uci", "origin_airport", "destination_airport", F.col("departure_ts").cast("string"))
    report = enriched.groupBy("country", "day_of_week", "season").agg(
        F.countDistinct(key).alias("passenger_count"),
        F.countDistinct(F.when(F.col("passenger_type") == "ADT", key)).alias("adults_count"),
        F.countDistinct(F.when(F.col("passenger_type") == "CHD", key)).alias("children_count"),
        F.avg("passenger_age").alias("average_age"),
    )
    report.count()
    rows = report.orderBy(F.col("passenger_count").desc()).collect()
    latest.unpersist()
    return rows


def formatted_key_parquet_report(spark, legs_dir, airports, cfg):
    """Comparison: latest status partitioned by a formatted departure
    string (as the original does); the date range then cannot move below
    the window, so every stored month is read."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from paxflow.operators.enrich import enrich
    from paxflow.operators.report import passenger_report
    from paxflow.operators.rules import departing_between, departing_from, operated_by

    legs = spark.read.parquet(legs_dir).drop("departure_month")
    w = Window.partitionBy(
        "passenger_uci", "origin_airport", "destination_airport",
        F.date_format("departure_ts", "yyyy-MM-dd'T'HH:mm:ss"),
    ).orderBy(F.col("booking_ts").desc_nulls_last(), F.col("booking_status"))
    latest = legs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    kept = latest.filter(F.col("booking_status") == "CONFIRMED")
    kept = departing_from(operated_by(departing_between(kept, cfg.start, cfg.end), cfg.airline), cfg.origins)
    return passenger_report(enrich(kept, airports, cfg.tz_from)).collect()


def complete_mode_stream(spark, lines_dir, airports, cfg, base, files_per_trigger):
    """Comparison: latest status as a complete-mode aggregation whose whole
    state is rewritten by foreachBatch on every trigger."""
    from pyspark.sql import functions as F

    from paxflow.operators.report import top_country_per_day
    from paxflow.streaming import stream as st
    from paxflow.streaming.ledger import Ledger

    legs = st.stream_legs(st.stream_lines(spark, lines_dir, max_files_per_trigger=files_per_trigger), cfg)

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/snapshot")

    q = (
        st.current_status(legs).writeStream.outputMode("complete")
        .option("checkpointLocation", f"{base}/checkpoint").foreachBatch(write)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    from paxflow.operators.enrich import enrich
    from paxflow.operators.rules import departing_between, departing_from, operated_by

    latest = spark.read.parquet(f"{base}/snapshot").filter(F.col("booking_status") == "CONFIRMED")
    kept = departing_from(operated_by(departing_between(latest, cfg.start, cfg.end), cfg.airline), cfg.origins)
    return top_country_per_day(enrich(kept, airports, cfg.tz_from)).collect()


def two_explode_legs(events):
    """Comparison for parse_legs: two explode generators in one select
    (nested Generate nodes) instead of one inline(flatten(transform))."""
    from pyspark.sql import functions as F

    pairs = events.select("booking_ts", F.explode("passengers").alias("p"), F.explode("products").alias("d"))
    return pairs.filter(
        F.col("p.uci").isNotNull() & F.col("d.origin_airport").isNotNull() & F.col("d.destination_airport").isNotNull()
        & F.col("d.operating_airline").isNotNull() & F.col("d.departure_ts").isNotNull() & F.col("d.arrival_ts").isNotNull()
    ).select(
        "booking_ts", F.col("p.uci").alias("passenger_uci"), F.col("p.passenger_type").alias("passenger_type"),
        F.col("p.age").alias("passenger_age"), "d.booking_status", "d.origin_airport", "d.destination_airport",
        "d.operating_airline", "d.departure_ts", "d.arrival_ts",
    )


def main():
    spark = session()
    from pyspark.sql import functions as F

    from paxflow.operators.enrich import enrich
    from paxflow.operators.report import top_country_per_day
    from paxflow.operators.rules import apply_rules, event_rules
    from paxflow.operators.status import latest_status, latest_status_agg
    from paxflow.plans.catalog import EVENT_CFG, REPORT_CFG
    from paxflow.plans.pipeline import report_from_legs, rule_legs, run_report
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.airports import read_airports
    from paxflow.sources.bookings import explode_legs, parse_events, read_booking_events
    from paxflow.sources.legstore import read_leg_store, write_leg_store
    from paxflow.sources.sinks import write_lines
    from paxflow.sources.tables import airport_lines, booking_lines
    from paxflow.streaming import stream as st
    from paxflow.streaming.ledger import Ledger

    base = shared_dir(spark, "bench")
    lines_dir, airports_dir, legs_dir = f"{base}/bookings", f"{base}/airports", f"{base}/legs"
    t0 = time.perf_counter()
    write_lines(booking_lines(spark, SF_DIR), lines_dir, files=2 * CPUS)
    write_lines(airport_lines(spark, SF_DIR), airports_dir, extension=".csv", files=1)
    write_leg_store(explode_legs(parse_events(read_booking_events(spark, lines_dir))), legs_dir)
    setup = round(time.perf_counter() - t0, 3)
    spark._jvm.System.gc()  # start the timed cases without the set-up's garbage

    def events():
        return parse_events(read_booking_events(spark, lines_dir))

    def legs():
        return explode_legs(events())

    airports = read_airports(spark, airports_dir)
    q = {}
    q["passenger_report"] = timed(lambda: run_report(spark, lines_dir, airports_dir, REPORT_CFG).collect())
    q["parse_legs"] = timed(lambda: noop(legs()))
    q["parse_legs_two_explodes"] = timed(lambda: noop(two_explode_legs(events())))
    q["latest_status"] = timed(lambda: noop(latest_status(legs())))
    q["latest_status_agg"] = timed(lambda: noop(latest_status_agg(legs())))
    q["event_rules"] = timed(lambda: noop(event_rules(events(), EVENT_CFG)))

    def parquet_report():
        stored = read_leg_store(spark, legs_dir, EVENT_CFG.start, EVENT_CFG.end, EVENT_CFG.origins)
        return report_from_legs(stored, airports, EVENT_CFG).collect()

    pruned = read_leg_store(spark, legs_dir, EVENT_CFG.start, EVENT_CFG.end, EVENT_CFG.origins)
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString(), "the leg store is not pruned"

    q["legs_parquet_report"] = timed(parquet_report)
    q["legs_parquet_report_formatted_key"] = timed(
        lambda: formatted_key_parquet_report(spark, legs_dir, airports, EVENT_CFG)
    )

    def stream_once():
        run = shared_dir(spark, "bench-stream")
        s = st.stream_legs(st.stream_lines(spark, lines_dir, max_files_per_trigger=max(1, CPUS // 2)), REPORT_CFG)
        st.start_leg_state(s, f"{run}/state", f"{run}/checkpoint", available_now=True).awaitTermination()
        return st.top_countries_from_state(spark, f"{run}/state", airports, REPORT_CFG).collect()

    q["stream_top_countries"] = timed(stream_once, reps=3)

    def ledger_once():
        run = shared_dir(spark, "bench-ledger")
        ledger = Ledger(spark, f"{run}/ledger", REPORT_CFG)
        s = st.stream_legs(st.stream_lines(spark, lines_dir, max_files_per_trigger=max(1, CPUS // 2)), REPORT_CFG)
        ledger.start(s, f"{run}/checkpoint", available_now=True).awaitTermination()
        noop(ledger.countries(airports))

    q["stream_ledger"] = timed(ledger_once, reps=3)
    q["stream_top_countries_complete_mode"] = timed(
        lambda: complete_mode_stream(
            spark, lines_dir, airports, REPORT_CFG, shared_dir(spark, "bench-complete"), max(1, CPUS // 2)
        ),
        reps=3,
    )
    q["batch_top_country_per_day"] = timed(
        lambda: top_country_per_day(
            enrich(apply_rules(rule_legs(read_booking_events(spark, lines_dir), REPORT_CFG), REPORT_CFG), airports, REPORT_CFG.tz_from)
        ).collect()
    )
    q["reference_style_report"] = timed(
        lambda: reference_style_report(spark, lines_dir, airports_dir, REPORT_CFG)
    )
    # Spark jobs per report run (AQE query stages count as jobs), and the
    # stage row counts gathered in the same run through observe().
    from paxflow.plans.pipeline import observed_report

    sc = spark.sparkContext

    def jobs_of(group, fn):
        sc.setJobGroup(group, group)
        try:
            fn()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    holder = {}

    def observed():
        rep, counts = observed_report(read_booking_events(spark, lines_dir), read_airports(spark, airports_dir), REPORT_CFG)
        rep.collect()
        holder["counts"] = counts.get()

    jobs = {
        "passenger_report_observed": jobs_of("paxflow-observed", observed),
        "reference_style_report": jobs_of(
            "paxflow-reference-style", lambda: reference_style_report(spark, lines_dir, airports_dir, REPORT_CFG)
        ),
    }
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(q[k] for k in HEADLINE), 3),
        "unit": "sec",
        "queries": q,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": CPUS,
        "reps": REPS,
        "setup_sec": setup,
        "speedup_vs_reference_style": round(q["reference_style_report"] / q["passenger_report"], 2),
        "spark_jobs_per_run": jobs,
        "stage_counts": holder.get("counts"),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
