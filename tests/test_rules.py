"""Leg-level and event-level rules, latest status."""

import datetime as dt

import pytest
from golden import EVENT_LINES, lines_df, rows

from paxflow.config import RuleConfig
from paxflow.operators import rules as ru
from paxflow.operators.status import latest_status, latest_status_agg
from paxflow.sources.bookings import explode_legs, parse_events

LEG_DDL = (
    "passenger_uci STRING, passenger_type STRING, passenger_age INT, booking_status STRING, "
    "origin_airport STRING, destination_airport STRING, departure_ts TIMESTAMP_NTZ, "
    "arrival_ts TIMESTAMP_NTZ, operating_airline STRING, booking_ts TIMESTAMP_NTZ"
)
T = dt.datetime


WINDOW = (dt.date(2022, 11, 5), dt.date(2022, 11, 20))


def boundary_legs(spark):
    """One leg per way to miss a rule, and two that meet them all."""
    booked, inside = T(2022, 8, 14, 5), T(2022, 11, 12, 3)

    def leg(uci, status="CONFIRMED", origin="MST", departure=inside, airline="KL"):
        return (uci, "ADT", 44, status, origin, "TLL", departure, departure + dt.timedelta(hours=3), airline, booked)

    return spark.createDataFrame(
        [
            leg("first day", departure=T(2022, 11, 5)),
            leg("last day", origin="GRQ", departure=T(2022, 11, 20, 23, 59)),
            leg("too late", departure=T(2022, 11, 21)),
            leg("too early", departure=T(2022, 11, 4, 23, 59)),
            leg("cancelled", status="CANCELLED"),
            leg("other airline", airline="BT"),
            leg("other origin", origin="HEL"),
        ],
        LEG_DDL,
    )


def test_leg_filters(spark):
    legs = boundary_legs(spark)
    names = lambda df: {r.passenger_uci for r in df.collect()}
    every = names(legs)
    assert names(ru.departing_between(legs, *WINDOW)) == every - {"too late", "too early"}
    assert names(ru.operated_by(legs, "KL")) == every - {"other airline"}
    assert names(ru.departing_from(legs, ("MST", "GRQ"))) == every - {"other origin"}
    assert names(ru.confirmed_now(legs)) == every - {"cancelled"}
    assert names(ru.apply_rules(legs, RuleConfig(start=WINDOW[0], end=WINDOW[1]))) == {"first day", "last day"}


def test_date_bounds_are_inclusive_utc_days(spark):
    deps = [T(2019, 5, 31, 23, 59, 59), T(2019, 6, 1), T(2019, 6, 30, 23, 59, 59), T(2019, 7, 1)]
    df = spark.createDataFrame([(d,) for d in deps], "departure_ts TIMESTAMP_NTZ")
    got = [r[0] for r in ru.departing_between(df, dt.date(2019, 6, 1), dt.date(2019, 6, 30)).collect()]
    assert got == deps[1:3]
    assert ru.departing_between(df, None, dt.date(2019, 6, 1)).count() == 2
    assert ru.departing_between(df, dt.date(2019, 6, 2), None).count() == 2


def _history(spark, statuses):
    data = [
        ("P", "ADT", 30, st, "AMS", "JFK", T(2019, 6, 15), T(2019, 6, 16), "KL", ts)
        for st, ts in statuses
    ]
    return spark.createDataFrame(data, LEG_DDL)


def test_latest_event_wins(spark):
    legs = _history(spark, [("CONFIRMED", T(2019, 1, 1)), ("CANCELLED", T(2019, 1, 2))])
    for fn in (latest_status, latest_status_agg):
        got = rows(fn(legs).select("booking_status", "is_confirmed"))
        assert got == [("CANCELLED", False)]
    legs = _history(spark, [("CANCELLED", T(2019, 1, 1)), ("CONFIRMED", T(2019, 1, 2)), ("CANCELLED", None)])
    for fn in (latest_status, latest_status_agg):
        assert rows(fn(legs).select("booking_status")) == [("CONFIRMED",)]


def test_equal_timestamps_tie_break(spark):
    legs = _history(spark, [("CONFIRMED", T(2019, 1, 1)), ("CANCELLED", T(2019, 1, 1))])
    for fn in (latest_status, latest_status_agg):
        assert rows(fn(legs).select("booking_status")) == [("CANCELLED",)]
        assert rows(fn(legs, tie_break="confirmed_first").select("booking_status")) == [("CONFIRMED",)]


def _line(ts, products, uci="P1"):
    prods = ",".join(
        f'{{"bookingStatus":"{st}","flight":{{"originAirport":"{o}","destinationAirport":"{d}",'
        f'"departureDate":"{dep}","arrivalDate":"{dep}","operatingAirline":"{al}"}}}}'
        for st, o, d, dep, al in products
    )
    return (
        f'{{"timestamp":"{ts}","event":{{"DataElement":{{"travelrecord":{{"passengersList":'
        f'[{{"uci":"{uci}","passengerType":"ADT","age":30,"tattoo":1}}],"productsList":[{prods}]}}}}}}}}'
    )


RANGE = RuleConfig(start=WINDOW[0], end=WINDOW[1])
# The middle product alone meets every rule: the others miss the date, the airline, the status and the origin.
FIVE = _line(
    "2022-08-14T05:00:00Z",
    [
        ("CONFIRMED", "RTM", "TLL", "2022-11-21T00:00:00Z", "KL"),
        ("CONFIRMED", "RTM", "VNO", "2022-11-06T07:00:00Z", "BT"),
        ("confirmed", "EIN", "RIX", "2022-11-20T23:00:00Z", "KL"),
        ("CANCELLED", "EIN", "TLL", "2022-11-07T07:00:00Z", "KL"),
        ("CONFIRMED", "VNO", "EIN", "2022-11-08T07:00:00Z", "KL"),
    ],
)
CFG = RuleConfig(start=dt.date(2019, 6, 1), end=dt.date(2019, 6, 30))


def test_only_the_product_that_meets_all_rules_qualifies(spark):
    ev = ru.qualifying_products(parse_events(lines_df(spark, [FIVE])), RANGE)
    got = [(p.origin_airport, p.destination_airport) for p in ev.collect()[0].products]
    assert got == [("EIN", "RIX")]


def test_event_any_leg_vs_leg_level(spark):
    # airline KL only on a leg from LHR, origin AMS only on an AF leg:
    split = _line(
        "2019-03-01T10:00:00Z",
        [("CONFIRMED", "LHR", "JFK", "2019-06-15T10:00:00Z", "KL"), ("CONFIRMED", "AMS", "CDG", "2019-06-16T10:00:00Z", "AF")],
    )
    events = parse_events(lines_df(spark, [split]))
    assert ru.event_rules(events, CFG).count() == 1
    assert ru.apply_rules(explode_legs(events), CFG).count() == 0
    assert ru.qualifying_products(events, CFG).count() == 0


def test_event_has_confirmed_latest_leg(spark):
    first = _line("2019-03-01T10:00:00Z", [("CONFIRMED", "AMS", "JFK", "2019-06-15T10:00:00Z", "KL")])
    later = _line("2019-03-02T10:00:00Z", [("CANCELLED", "AMS", "JFK", "2019-06-15T10:00:00Z", "KL")])
    other = _line("2019-03-01T10:00:00Z", [("CONFIRMED", "AMS", "LHR", "2019-06-15T10:00:00Z", "KL")], uci="P2")
    events = parse_events(lines_df(spark, [first, later, other, other]))
    latest = latest_status(explode_legs(events))
    kept = ru.with_confirmed_leg(events, latest)
    assert sorted(r.passengers[0].uci for r in kept.collect()) == ["P2", "P2"]


def test_origin_set_from_dimension(spark):
    codes = spark.createDataFrame([("MST",), ("MST",), ("AMS",)], "iata STRING")
    assert ru.departing_from(boundary_legs(spark), codes).count() == 5


def test_event_rules_follow_the_latest_status(spark):
    lines = [
        FIVE,
        _line("2022-08-15T05:00:00Z", [("CANCELLED", "EIN", "RIX", "2022-11-20T23:00:00Z", "KL")]),
        _line("2022-08-14T05:00:00Z", [("CONFIRMED", "AMS", "TLL", "2022-11-10T10:00:00Z", "KL")], uci="P2"),
        _line("2022-08-14T05:00:00Z", [("CONFIRMED", "AMS", "TLL", "2022-12-10T10:00:00Z", "KL")], uci="P3"),
        # once confirmed, cancelled by a later event outside the rules of the first
        _line("2022-08-14T05:00:00Z", [("CONFIRMED", "AMS", "RIX", "2022-11-11T10:00:00Z", "KL")], uci="P4"),
        _line("2022-08-16T05:00:00Z", [("CANCELLED", "AMS", "RIX", "2022-11-11T10:00:00Z", "BT")], uci="P4"),
    ]
    events = parse_events(lines_df(spark, lines))
    got = sorted(r.passengers[0].uci for r in ru.event_rules(events, RANGE).collect())
    # P1 stays: the event's other legs are still confirmed
    assert got == ["P1", "P2"]


def test_events_that_differ_by_a_missing_date_are_told_apart(spark):
    """Equal values in neighbouring fields: only the event that has the confirmed leg stays."""
    when = "2022-11-10T10:00:00Z"
    template = _line("2022-08-14T05:00:00Z", [("CONFIRMED", "AMS", "TLL", when, "KL")], uci="Q")
    both = f'"departureDate":"{when}","arrivalDate":"{when}"'
    no_arrival = template.replace(both, f'"departureDate":"{when}"')
    no_departure = template.replace(both, f'"arrivalDate":"{when}"')
    events = parse_events(lines_df(spark, [no_arrival, no_departure, template]))
    assert len({tuple(r.event_id) for r in events.collect()}) == 3
    latest = latest_status(explode_legs(events))
    kept = ru.with_confirmed_leg(events, latest).collect()
    assert sorted(p.arrival_ts is None for r in kept for p in r.products) == [False, True]
    assert all(r.products[0].departure_ts is not None for r in kept)


@pytest.mark.parametrize("tie_break", ["cancelled_first", "confirmed_first"])
def test_confirmed_events_equal_the_join_with_the_latest_status(spark, tie_break):
    events = parse_events(lines_df(spark, EVENT_LINES * 2))
    latest = latest_status(explode_legs(events), tie_break)
    got = ru.confirmed_events(events, tie_break)
    assert got.columns == events.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, ru.with_confirmed_leg(events, latest).collect()))
    assert "from_json" not in got._jdf.queryExecution().executedPlan().toString()
