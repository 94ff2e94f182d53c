"""Physical plans: the shapes that matter at scale."""

import datetime as dt

from pyspark.sql import functions as F

from golden import AIRPORT_LINES, END, EVENT_LINES, START, lines_df

from paxflow.config import RuleConfig
from paxflow.operators.status import latest_status
from paxflow.plans.pipeline import report_from_legs, report_from_lines
from paxflow.sources.airports import clean_airports, parse_airport_lines
from paxflow.sources.bookings import explode_legs, parse_events
from paxflow.sources.legstore import read_leg_store, write_leg_store

CFG = RuleConfig(start=START, end=END)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def airports(spark):
    return clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))


def test_latest_status_limits_before_the_shuffle(spark):
    p = plan(latest_status(explode_legs(parse_events(lines_df(spark, EVENT_LINES)))))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    partial, exchange = p.index("Partial"), p.index("Exchange hashpartitioning")
    assert exchange < partial  # Partial sits below (printed after) the exchange


def test_report_plan_stays_in_the_jvm(spark):
    rep = report_from_lines(lines_df(spark, EVENT_LINES), airports(spark), CFG)
    p = plan(rep)
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in p
    assert "BroadcastHashJoin" in p
    import re

    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", p)
    # two shuffles on the fact side (leg key, report group); the rest are
    # the small airport dimension's deduplication
    assert sorted(k for k in keys if k != "iata") == ["country", "passenger_uci"]


def test_key_predicates_go_below_the_window(spark):
    legs = explode_legs(parse_events(lines_df(spark, EVENT_LINES)))
    from paxflow.operators.rules import apply_rules

    p = plan(apply_rules(legs, CFG))
    below = p[p.index("Window [") :]
    # printed after the window node = evaluated below it
    assert "IN (AMS,EIN,RTM,GRQ,MST)" in below
    assert ">= 2021-09-01 00:00:00" in below and "< 2021-10-01 00:00:00" in below
    assert "= CONFIRMED" not in below  # not a key: must stay above


def test_leg_store_prunes_and_pushes(spark, scratch):
    path = scratch("legstore")
    legs = explode_legs(parse_events(lines_df(spark, EVENT_LINES)))
    write_leg_store(legs, path)
    stored = read_leg_store(spark, path, START, END, CFG.origins)
    p = formatted(stored)
    assert "PartitionFilters: [isnotnull(departure_month" in p
    assert "PushedFilters:" in p and "GreaterThanOrEqual(departure_ts" in p and "In(origin_airport" in p
    got = sorted(tuple(r) for r in report_from_legs(stored, airports(spark), CFG).collect())
    want = sorted(tuple(r) for r in report_from_lines(lines_df(spark, EVENT_LINES), airports(spark), CFG).collect())
    assert got == want
    outside = read_leg_store(spark, path, dt.date(2020, 1, 1), dt.date(2020, 12, 31))
    assert outside.count() == 0


def test_event_rules_parse_once_and_shuffle_asked_legs_only(spark):
    from paxflow.operators.rules import event_rules, facts_and_candidates, with_confirmed_leg

    events = parse_events(lines_df(spark, EVENT_LINES))
    kept = event_rules(events, CFG)
    p = plan(kept)
    # nothing of the feed is left in the plan: it was parsed once, when facts and candidates were stored
    assert "from_json" not in p and "ExistingRDD" not in p
    scans = [line for line in formatted(kept).splitlines() if line.startswith("ReadSchema")]
    narrow = [s for s in scans if "event:struct" not in s]
    assert len(scans) - len(narrow) == 1 and len(narrow) >= 2  # only the last join sees whole events
    # the facts meet the asked keys before they are shuffled
    latest = p[p.index("WindowGroupLimit") :]
    assert latest.index("BroadcastHashJoin") < latest.index("FileScan parquet")
    facts, candidates = facts_and_candidates(events, F.lit(None).cast("boolean"))
    assert candidates.count() == 0 and candidates.columns == ["row", *events.columns] and facts.count() > 10
    semi = with_confirmed_leg(events, latest_status(explode_legs(events)))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in semi and "checkpoint" not in semi


def test_stage_counts_parse_the_feed_once(spark):
    from paxflow.plans.pipeline import observed_report

    report, _ = observed_report(lines_df(spark, EVENT_LINES), airports(spark), CFG)
    assert plan(report).count("from_json(") == 1


def test_lines_are_parsed_once(spark):
    legs = explode_legs(parse_events(lines_df(spark, EVENT_LINES)))
    physical = legs._jdf.queryExecution().executedPlan().toString()
    assert physical.count("from_json(") == 1  # the validity filter does not copy it
    airports_plan = airports(spark)._jdf.queryExecution().executedPlan().toString()
    assert airports_plan.count("from_csv(") == 1


def test_both_airport_lookups_share_one_broadcast(spark):
    report = report_from_lines(lines_df(spark, EVENT_LINES), airports(spark), CFG)
    report.collect()
    final = plan(report).split("Initial Plan")[0]
    assert final.count("BroadcastHashJoin") == 2 and final.count("from_csv(") == 1
    assert final.count("ReusedExchange") >= 1
