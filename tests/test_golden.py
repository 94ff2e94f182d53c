"""FIXTURES golden set: the full chain from raw lines to report rows."""

import random

import pytest
from golden import (
    AIRPORT_LINES, BROKEN_LINE, CANONICAL, CONFIRMED_FIRST, DESTINATION_TZ, END, EVENT_LINES, NO_RECORD_LINE, START, lines_df,
    rows, write_files,
)

from paxflow.config import RuleConfig
from paxflow.operators.report import order_report, report_rows
from paxflow.plans.pipeline import observed_report, report_from_lines, run_report
from paxflow.sources.airports import clean_airports, parse_airport_lines
from paxflow.sources.bookings import quarantine

CFG = RuleConfig(start=START, end=END)


@pytest.fixture(scope="module")
def airports(spark):
    return clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))


def report(spark, airports, cfg, lines=EVENT_LINES):
    return rows(order_report(report_rows(report_from_lines(lines_df(spark, lines), airports, cfg))))


def test_canonical(spark, airports):
    assert report(spark, airports, CFG) == CANONICAL


def test_destination_zone(spark, airports):
    assert report(spark, airports, CFG.with_(tz_from="destination")) == DESTINATION_TZ


def test_confirmed_first(spark, airports):
    assert report(spark, airports, CFG.with_(tie_break="confirmed_first")) == CONFIRMED_FIRST


def test_quarantine_lines(spark):
    got = sorted(rows(quarantine(lines_df(spark, EVENT_LINES))))
    assert got == sorted([(BROKEN_LINE, "malformed_json"), (NO_RECORD_LINE, "missing_travelrecord")])


def test_files_end_to_end(spark, scratch):
    base = scratch("golden")
    write_files(spark, f"{base}/bookings", EVENT_LINES)
    write_files(spark, f"{base}/bookings/notes", ["not a booking"], extension=".txt")
    write_files(spark, f"{base}/airports", AIRPORT_LINES, extension=".csv")
    got = rows(run_report(spark, f"{base}/bookings", f"{base}/airports", CFG))
    assert got == CANONICAL


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "Pacific/Kiritimati"])
def test_session_zone_does_not_matter(spark, airports, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert report(spark, airports, CFG) == CANONICAL
        assert report(spark, airports, CFG.with_(tz_from="destination")) == DESTINATION_TZ
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_line_order_does_not_matter(spark, airports):
    for seed in range(3):
        shuffled = EVENT_LINES[:]
        random.Random(seed).shuffle(shuffled)
        assert report(spark, airports, CFG, shuffled) == CANONICAL


def test_stage_counts_observed(spark, airports):
    rep, counts = observed_report(lines_df(spark, EVENT_LINES), airports, CFG)
    assert len(rep.collect()) == 2
    got = counts.get()
    assert got["groups"] == 2
    assert got["enriched"] == 2
    assert got["events"] == len(EVENT_LINES) - 2
    assert got["legs"] >= got["latest_confirmed"] >= got["enriched"]
