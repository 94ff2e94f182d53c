"""Ingest: timestamps, malformed input, flattening, strict mode, airports."""

import datetime as dt

from golden import AIRPORT_LINES, lines_df, rows

from paxflow.functions.instants import utc_instant
from paxflow.sources.airports import clean_airports, parse_airport_lines, read_airports
from paxflow.sources.bookings import explode_legs, parse_events, quarantine


def _ts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    return [r[0] for r in df.select(utc_instant("v")).collect()]


def test_timestamp_forms(spark):
    got = _ts(
        spark,
        [
            "2019-06-15T22:30:00Z",
            "2019-06-15T22:30:00.475Z",
            "2019-06-16T00:30:00+02:00",
            "2019-06-16T00:30:00+0200",
            "2019-06-15T22:30:00",
            "2019-06-15",
            "junk",
            None,
            "12:30:00Z", "T12:30:00Z", "12:30", "2019", "2019-06", "2019-6-1", " 2019-06-15T22:30:00Z ",
        ],
    )
    base = dt.datetime(2019, 6, 15, 22, 30)
    assert got == [
        base,
        base.replace(microsecond=475000),
        base,
        base,
        base,
        dt.datetime(2019, 6, 15),
        None,
        None,
        *[None] * 6,
        base,
    ]


def _event(pax, prods, ts="2019-03-01T10:00:00Z"):
    return f'{{"timestamp":"{ts}","event":{{"DataElement":{{"travelrecord":{{"passengersList":{pax},"productsList":{prods}}}}}}}}}'


FLIGHT = '{"originAirport":"AMS","destinationAirport":"JFK","departureDate":"2019-06-15T22:30:00Z","arrivalDate":"2019-06-16T06:30:00Z","operatingAirline":"KL"}'
GOOD_PAX = '{"uci":"A","passengerType":"adt","age":30,"tattoo":1}'
BAD_PAX = '{"passengerType":"ADT","age":30,"tattoo":2}'
PROD = f'{{"bookingStatus":"confirmed","flight":{FLIGHT}}}'


def test_row_level_drops_only_the_bad_member(spark):
    lines = [_event(f"[{GOOD_PAX},{BAD_PAX}]", f"[{PROD},null]"), "", "   "]
    legs = rows(explode_legs(parse_events(lines_df(spark, lines))).select("passenger_uci", "passenger_type", "booking_status"))
    assert legs == [("A", "ADT", "CONFIRMED")]
    assert rows(quarantine(lines_df(spark, lines))) == []


def test_strict_drops_the_event(spark):
    lines = [_event(f"[{GOOD_PAX},{BAD_PAX}]", f"[{PROD}]"), _event(f"[{GOOD_PAX}]", f"[{PROD}]")]
    events = parse_events(lines_df(spark, lines), strict=True)
    assert events.count() == 1
    assert [r.reason for r in quarantine(lines_df(spark, lines), strict=True).collect()] == ["invalid_member"]


def test_empty_or_missing_arrays_give_no_legs(spark):
    lines = [_event("[]", f"[{PROD}]"), _event(f"[{GOOD_PAX}]", "null"), '{"timestamp":"x","event":{"DataElement":{}}}']
    assert explode_legs(parse_events(lines_df(spark, lines))).count() == 0
    reasons = sorted(r.reason for r in quarantine(lines_df(spark, lines)).collect())
    assert reasons == ["missing_travelrecord"]


def test_cross_product_of_passengers_and_products(spark):
    prod2 = PROD.replace('"JFK"', '"LHR"')
    pax2 = GOOD_PAX.replace('"A"', '"B"')
    lines = [_event(f"[{GOOD_PAX},{pax2}]", f"[{PROD},{prod2}]")]
    got = sorted(rows(explode_legs(parse_events(lines_df(spark, lines))).select("passenger_uci", "destination_airport")))
    assert got == [("A", "JFK"), ("A", "LHR"), ("B", "JFK"), ("B", "LHR")]


def test_unparsable_departure_drops_the_leg(spark):
    bad = PROD.replace("2019-06-15T22:30:00Z", "not a date")
    lines = [_event(f"[{GOOD_PAX}]", f"[{bad},{PROD}]")]
    assert explode_legs(parse_events(lines_df(spark, lines))).count() == 1


def test_airports_fixture(spark):
    dim = {r.iata: r for r in clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES))).collect()}
    assert sorted(dim) == ["EIN", "KEF", "KIX"]
    assert dim["EIN"].country == "Netherlands" and dim["EIN"].tz == "Europe/Amsterdam"
    assert dim["KIX"].timezone_offset == 9.0
    assert dim["KEF"].altitude == 171


def test_airport_defaults_duplicates_and_zones(spark, scratch):
    lines = [
        '10,"A","X","Land","AAA","ICAO",1.5,2.5,7,1,E,"Europe/Paris","airport","S"',
        '11,"A2","X","Other","AAA",,abc,2.5,\\N,1,E,"Invalid/Zone","airport","S"',
        '12,"B","Y",\\N,"BBB",\\N,0,0,0,0,\\N,,\\N,\\N',
        '13,"C","Z","Land","",\\N,0,0,0,0,E,"UTC","airport","S"',
        '14,"D","Z","Land","DDD",\\N,0,0,0,0,E,"UTC","airport","S","extra"',
    ]
    from golden import write_files

    path = write_files(spark, scratch("airports"), lines, extension=".csv")
    for dim_df in (clean_airports(parse_airport_lines(lines_df(spark, lines))), read_airports(spark, path)):
        dim = {r.iata: r for r in dim_df.collect()}
        assert sorted(dim) == ["AAA", "BBB", "DDD"]
        a = dim["AAA"]  # highest airport_id wins
        assert (a.airport_id, a.country, a.latitude, a.altitude, a.tz_database, a.tz) == (
            11, "Other", 0.0, 0, "Invalid/Zone", "UTC"
        )
        b = dim["BBB"]
        assert (b.country, b.icao, b.dst, b.tz_database, b.tz, b.airport_type, b.source) == (
            "", None, "N", "", "", "unknown", "Unknown"
        )


def test_padded_and_blank_zones(spark):
    from paxflow.operators.enrich import enrich

    lines = [
        f'{k},"A","X","Land","{code}",\\N,0,0,0,0,E,"{zone}","airport","S"'
        for k, (code, zone) in enumerate([("LPD", " Europe/London"), ("RPD", "Europe/London "), ("BLK", "  "), ("BAD", " Mars/Base ")])
    ]
    dim = clean_airports(parse_airport_lines(lines_df(spark, lines)))
    assert {r.iata: r.tz for r in dim.collect()} == {"LPD": "Europe/London", "RPD": "Europe/London", "BLK": "", "BAD": "UTC"}
    legs = spark.createDataFrame(
        [("p", o, "RPD", dt.datetime(2020, 7, 4, 23, 30)) for o in ("LPD", "RPD", "BLK", "BAD")],
        "passenger_uci STRING, origin_airport STRING, destination_airport STRING, departure_ts TIMESTAMP_NTZ",
    )
    days = {r.origin_airport: r.day_of_week for r in enrich(legs, dim).collect()}
    assert days == {"LPD": "Sunday", "RPD": "Sunday", "BLK": "Sunday", "BAD": "Saturday"}


def test_legs_and_rejected_legs_are_all_pairs(spark):
    from paxflow.sources.bookings import quarantine_legs

    no_origin = PROD.replace('"originAirport":"AMS",', "")
    bad_date = PROD.replace("2019-06-15T22:30:00Z", "12:30:00Z")
    lines = [
        _event(f"[{GOOD_PAX},{BAD_PAX}]", f"[{PROD},null,{no_origin},{bad_date}]"),
        _event(f"[{GOOD_PAX},null]", f"[{PROD}]"),
        _event("[]", f"[{PROD}]"),
    ]
    rejects = quarantine_legs(lines_df(spark, lines))
    got = sorted(r.reason for r in rejects.collect())
    assert got == ["invalid_departure", "missing_origin", "missing_passenger", "missing_product", *["missing_uci"] * 4]
    assert explode_legs(parse_events(lines_df(spark, lines))).count() + len(got) == 2 * 4 + 2 * 1
    assert '"departureDate":"12:30:00Z"' in rejects.filter("reason = 'invalid_departure'").first().product


def test_directory_scan_is_not_recursive_and_filters_names(spark, scratch):
    from golden import EVENT_LINES, write_files

    from paxflow.sources.bookings import read_booking_events

    base = scratch("scan")
    write_files(spark, f"{base}/in", EVENT_LINES[:2])
    write_files(spark, f"{base}/in/sub", EVENT_LINES[2:4])
    write_files(spark, f"{base}/in", EVENT_LINES[4:6], one_per_line=True, extension=".log")
    assert read_booking_events(spark, f"{base}/in").count() == 2  # *.json only, sub/ not descended
    assert read_booking_events(spark, f"{base}/in", glob=None).count() == 4  # + the two .log files


def test_missing_path_raises(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException

    from paxflow.sources.bookings import read_booking_events

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_booking_events(spark, scratch("missing") + "/nothing").count()


def test_numeric_members_as_text_or_bad_only_affect_their_field(spark):
    good = _event('[{"uci":"A","passengerType":"ADT","age":"30","tattoo":"1"}]', f"[{PROD}]")
    bad_age = _event('[{"uci":"B","passengerType":"ADT","age":"old","tattoo":1},' + GOOD_PAX + "]", f"[{PROD}]")
    legs = explode_legs(parse_events(lines_df(spark, [good, bad_age])))
    got = sorted(rows(legs.select("passenger_uci", "passenger_age")), key=lambda r: r[0])
    assert got == [("A", 30), ("A", 30), ("B", None)]
    assert rows(quarantine(lines_df(spark, [good, bad_age]))) == []
    strict = [r.reason for r in quarantine(lines_df(spark, [good, bad_age]), strict=True).collect()]
    assert strict == ["invalid_member"]
