"""Parameters, and how passengers are counted."""

import datetime as dt

import pytest
from golden import AIRPORT_LINES, lines_df

from paxflow.config import DEFAULT_ORIGINS, RuleConfig, parse_codes
from paxflow.plans.pipeline import report_from_lines
from paxflow.sources.airports import clean_airports, parse_airport_lines


def test_config_defaults_and_validation():
    cfg = RuleConfig(start=" 2019-06-01", end=dt.datetime(2019, 6, 30, 12))
    assert (cfg.start, cfg.end) == (dt.date(2019, 6, 1), dt.date(2019, 6, 30))
    assert cfg.origins == DEFAULT_ORIGINS == ("AMS", "EIN", "RTM", "GRQ", "MST")
    assert cfg.airline == "KL"
    assert RuleConfig(origins=" ams, ein ").origins == ("AMS", "EIN")
    assert parse_codes(" ams, Ein ,,rtm ") == ("AMS", "EIN", "RTM")
    with pytest.raises(ValueError):
        RuleConfig(start="2019-06-30", end="2019-06-01")
    for text in ("2019-06-01junk", "2019-06-01T00:00:00+02:00", "20190601x"):
        with pytest.raises(ValueError):
            RuleConfig(start=text)
    assert RuleConfig(origins="").origins == RuleConfig(origins=()).origins == DEFAULT_ORIGINS
    with pytest.raises(ValueError):
        RuleConfig(tz_from="airport")
    with pytest.raises(ValueError):
        RuleConfig(tie_break="latest")


def _line(passengers, products):
    pax = ",".join(f'{{"uci":"{u}","passengerType":"{t}","age":{a},"tattoo":1}}' for u, t, a in passengers)
    prods = ",".join(
        f'{{"bookingStatus":"CONFIRMED","flight":{{"originAirport":"RTM","destinationAirport":"{d}",'
        f'"departureDate":"{dep}","arrivalDate":"{dep}","operatingAirline":"KL"}}}}'
        for d, dep in products
    )
    return (
        '{"timestamp":"2021-02-03T04:05:06Z","event":{"DataElement":{"travelrecord":'
        f'{{"passengersList":[{pax}],"productsList":[{prods}]}}}}}}}}'
    )


def _report(spark, lines):
    airports = clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))
    cfg = RuleConfig(start="2021-03-01", end="2021-03-31")
    return {(r.country, r.day_of_week): (r.passenger_count, r.adults_count, r.children_count, r.average_age)
            for r in report_from_lines(lines_df(spark, lines), airports, cfg).collect()}


TUESDAY, FRIDAY = "2021-03-09T01:00:00Z", "2021-03-26T01:00:00Z"


def test_a_leg_counts_once_however_often_it_is_listed(spark):
    line = _line([("N7", "ADT", 58), ("N7", "ADT", 58)], [("KEF", TUESDAY), ("KEF", TUESDAY)])
    assert _report(spark, [line, line, line]) == {("Iceland", "Tuesday"): (1, 1, 0, 58.0)}


def test_each_leg_of_a_trip_counts_every_passenger(spark):
    line = _line([("N1", "ADT", 45), ("N2", "CHD", 12), ("N3", "CHD", 3), ("N4", "INF", 0)], [("KEF", TUESDAY), ("KIX", FRIDAY)])
    assert _report(spark, [line]) == {("Iceland", "Tuesday"): (4, 1, 2, 15.0), ("Japan", "Friday"): (4, 1, 2, 15.0)}
