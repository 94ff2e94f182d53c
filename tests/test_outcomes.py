"""One-pass ingest and the tolerant scan."""

import gzip

import pytest
from golden import AIRPORT_LINES, CANONICAL, EVENT_LINES, END, KIX, START, _event, lines_df, rows, write_files

from paxflow.config import RuleConfig
from paxflow.operators.report import order_report, report_rows
from paxflow.plans.pipeline import report_from_legs
from paxflow.schema import LEG_COLUMNS
from paxflow.sources.airports import clean_airports, parse_airport_lines
from paxflow.sources.bookings import explode_legs, parse_events, quarantine, quarantine_legs, read_booking_events
from paxflow.sources.ingest import booking_files, ingest_files, outcomes, store_outcomes

ODD = [
    _event("2021-05-01T00:00:00Z", [("V1", "adt", 3)], []),
    _event("2021-05-01T00:00:00Z", [], [("CONFIRMED", *KIX)]),
    '{"timestamp":"2021-05-01T00:00:00Z","event":{"DataElement":{"travelrecord":{"passengersList":[null,{"uci":"V2","passengerType":"ADT",'
    '"age":"x","tattoo":1},{"passengerType":"ADT","tattoo":2}],"productsList":[null,{"bookingStatus":"CONFIRMED"},{"bookingStatus":"ok",'
    '"flight":{"originAirport":"EIN","destinationAirport":"KIX","departureDate":"soon","arrivalDate":"2021-09-01","operatingAirline":"KL"}},'
    '{"bookingStatus":" confirmed ","flight":{"originAirport":"EIN","destinationAirport":"KIX","departureDate":"2021-09-01",'
    '"arrivalDate":"2021-09-01T01:00:00Z","operatingAirline":"KL"}}]}}}}',
    '{"timestamp":"x","event":{"DataElement":{"travelrecord":{}}}}',
    "",
    "   ",
]
LINES = EVENT_LINES + ODD


def bag(df):
    return sorted(map(str, rows(df)))


@pytest.mark.parametrize("strict", [False, True])
def test_stored_outcomes_equal_the_separate_passes(spark, scratch, strict):
    lines = lines_df(spark, LINES)
    feed = store_outcomes(lines, strict, scratch("outcomes"))
    assert bag(feed.legs()) == bag(explode_legs(parse_events(lines, strict=strict)).select(*LEG_COLUMNS))
    assert bag(feed.event_rejects()) == bag(quarantine(lines, strict))
    if not strict:
        assert bag(feed.leg_rejects()) == bag(quarantine_legs(lines))
    levels = {r.level for r in feed.rejects().collect()}
    assert levels == ({"event"} if strict else {"event", "leg"})


def test_every_line_has_an_outcome(spark, scratch):
    feed = store_outcomes(lines_df(spark, LINES), False, scratch("outcomes"))
    counts = {(r.outcome, r.reason): r.row_count for r in feed.counts().collect()}
    assert counts["no_pairs", None] == 3  # no product, no passenger, neither list
    assert counts["event_reject", "malformed_json"] == 1 and counts["event_reject", "missing_travelrecord"] == 1
    # 3 passengers x 4 products of the odd event: one leg, eleven rejects with their first reason
    odd = store_outcomes(lines_df(spark, ODD[2:3]), False, scratch("outcomes"))
    assert {(r.outcome, r.reason): r.row_count for r in odd.counts().collect()} == {
        ("leg", None): 1, ("leg_reject", "missing_passenger"): 4, ("leg_reject", "missing_uci"): 4,
        ("leg_reject", "missing_product"): 2, ("leg_reject", "invalid_departure"): 1,
    }


def test_the_feed_is_parsed_once_for_all_outputs(spark, scratch):
    base = scratch("once")
    write_files(spark, f"{base}/in", EVENT_LINES)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    scan = plan(outcomes(read_booking_events(spark, f"{base}/in", with_file=True)))
    assert scan.count("FileScan json") == 1 and scan.count("Generate ") == 1 and "Python" not in scan
    assert plan(outcomes(lines_df(spark, LINES))).count("from_json(") == 1
    feed = ingest_files(spark, f"{base}/in")
    dim = clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))
    cfg = RuleConfig(start=START, end=END)
    report = order_report(report_rows(report_from_legs(feed.legs(START, END), dim, cfg)))
    for output in (report, feed.rejects(), feed.counts(), feed.skipped(booking_files(spark, f"{base}/in"))):
        assert "FileScan json" not in plan(output)
    assert rows(report) == CANONICAL
    legs = plan(feed.legs(START, END))
    assert "departure_month" in legs.split("PartitionFilters: [")[1].split("]")[0]


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_unreadable_files_are_named_and_the_rest_is_kept(spark, scratch):
    import os

    base = scratch("tolerant")
    write_files(spark, f"{base}/in", EVENT_LINES)
    folder = local(f"{base}/in")
    many = "\n".join(_event(f"2021-05-01T00:00:{k % 60:02}Z", [(f"W{k}", "ADT", 9)], [("CONFIRMED", *KIX)]) for k in range(20_000)).encode()
    packed = gzip.compress(many)
    for name, content in {
        "broken.json.gz": b"no archive", "cut.json.gz": packed[: len(packed) * 3 // 4], "good.json.gz": gzip.compress(EVENT_LINES[0].encode()),
        "empty.json": b"", "notes.txt": b"not a booking",
    }.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(content)
    with pytest.raises(Exception, match="(?i)gzip|cannot read|FAILED_READ_FILE"):
        ingest_files(spark, f"{base}/in", "*.json*")
    feed = ingest_files(spark, f"{base}/in", "*.json*", skip_unreadable=True)
    skipped = feed.skipped(booking_files(spark, f"{base}/in", "*.json*")).collect()
    assert [r.file.rsplit("/", 1)[1] for r in skipped] == ["broken.json.gz"]
    kept = {r.passenger_uci for r in feed.legs().collect()}
    assert "V10" in kept and any(u.startswith("W") for u in kept)  # what came before the damage is kept
    whole = explode_legs(parse_events(read_booking_events(spark, f"{base}/in", "part*.json")))
    assert feed.legs().filter("passenger_uci not like 'W%'").count() == whole.count() + 1


def test_an_empty_feed(spark, scratch):
    feed = store_outcomes(lines_df(spark, [""]), False, scratch("outcomes"))
    assert feed.rows().count() == 0 and feed.legs(START, END).count() == 0 and feed.rejects().count() == 0
