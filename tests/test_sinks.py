"""Report sinks and empty input."""

import json

from golden import AIRPORT_LINES, CANONICAL, END, EVENT_LINES, START, lines_df, rows

from paxflow.config import RuleConfig
from paxflow.operators.report import order_report, report_rows
from paxflow.plans.pipeline import report_from_lines
from paxflow.sources.airports import clean_airports, parse_airport_lines
from paxflow.sources.sinks import read_report, write_report

CFG = RuleConfig(start=START, end=END)


def _report(spark, lines):
    airports = clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))
    return order_report(report_rows(report_from_lines(lines_df(spark, lines), airports, CFG)))


def test_csv_json_and_array_forms(spark, scratch):
    base = scratch("sinks")
    rep = _report(spark, EVENT_LINES)
    write_report(rep, f"{base}/r.csv")
    write_report(rep, f"{base}/r_snake", fmt="csv", labels=False)
    write_report(rep, f"{base}/r.json")
    write_report(rep, f"{base}/r_array", fmt="json_array")
    assert rows(read_report(spark, f"{base}/r.csv")) == CANONICAL
    header = spark.read.text(f"{base}/r_snake").first().value
    assert header.startswith("country,day_of_week,season,passenger_count")
    assert sorted(rows(read_report(spark, f"{base}/r.json"))) == sorted(CANONICAL)
    doc = json.loads(spark.read.text(f"{base}/r_array").first().value)
    assert isinstance(doc, list) and len(doc) == 2
    # the array keeps the report's order and its null fields
    assert [tuple(d.values()) for d in doc] == CANONICAL
    assert '"children_count":null' in spark.read.text(f"{base}/r.json").first().value


def test_empty_and_all_bad_input_give_empty_report(spark):
    assert _report(spark, []).count() == 0
    assert _report(spark, ["", "{oops", '{"timestamp":"x","event":{}}']).count() == 0


def test_first_destination(spark):
    from paxflow.operators.rules import first_destination
    from paxflow.sources.bookings import parse_events

    got = [r.first_destination for r in first_destination(parse_events(lines_df(spark, EVENT_LINES[4:6]))).collect()]
    assert got == ["KEF", "KIX"]


def test_empty_airport_dimension_gives_empty_report(spark):
    airports = clean_airports(parse_airport_lines(lines_df(spark, [])))
    assert report_from_lines(lines_df(spark, EVENT_LINES), airports, CFG).count() == 0
