"""Season, local day of week, country and zone fallbacks."""

import datetime as dt

from golden import lines_df

from paxflow.functions.instants import local_day_name, season_of
from paxflow.operators.enrich import enrich, unknown_destinations
from paxflow.sources.airports import clean_airports, parse_airport_lines

T = dt.datetime


def test_seasons_for_every_month(spark):
    months = [(T(2019, m, 15),) for m in range(1, 13)]
    df = spark.createDataFrame(months, "ts TIMESTAMP_NTZ")
    got = [r[0] for r in df.select(season_of("ts")).collect()]
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer", "Fall", "Fall", "Fall", "Winter"]


def test_day_in_zone(spark):
    df = spark.createDataFrame(
        [(T(2019, 6, 15, 22), "Europe/Amsterdam"), (T(2019, 6, 15, 22), "America/New_York"), (T(2019, 6, 15, 22), "UTC")],
        "ts TIMESTAMP_NTZ, z STRING",
    )
    assert [r[0] for r in df.select(local_day_name("ts", "z")).collect()] == ["Sunday", "Saturday", "Saturday"]


AIRPORTS = [
    '1,"A","A","Netherlands","AMS","X",0,0,0,1,E,"Europe/Amsterdam","airport","S"',
    '2,"J","J","United States","JFK","X",0,0,0,-5,A,"America/New_York","airport","S"',
    '3,"E","E","Nowhere Land","EMP","X",0,0,0,0,E,,"airport","S"',
    '4,"B","B","Badland","BAD","X",0,0,0,0,E,"Mars/Olympus","airport","S"',
    '5,"N","N",\\N,"NOC","X",0,0,0,0,E,"Asia/Tokyo","airport","S"',
    '6,"T","T","Tokyo","TYO","X",0,0,0,0,E,"Asia/Tokyo","airport","S"',
]
LEG_DDL = "passenger_uci STRING, origin_airport STRING, destination_airport STRING, departure_ts TIMESTAMP_NTZ"


def _enrich(spark, legs, tz_from="origin"):
    dim = clean_airports(parse_airport_lines(lines_df(spark, AIRPORTS)))
    df = spark.createDataFrame(legs, LEG_DDL)
    return {r.passenger_uci: (r.country, r.day_of_week, r.season) for r in enrich(df, dim, tz_from).collect()}


def test_zone_fallbacks(spark):
    ts = T(2019, 6, 15, 22)  # Saturday 22:00 UTC, Sunday in Amsterdam and Tokyo
    got = _enrich(
        spark,
        [
            ("origin_zone", "AMS", "JFK", ts),  # Amsterdam -> Sunday
            ("unknown_origin", "XXX", "TYO", ts),  # destination zone -> Sunday
            ("empty_origin_zone", "EMP", "TYO", ts),  # empty zone -> destination -> Sunday
            ("invalid_origin_zone", "BAD", "TYO", ts),  # unknown zone -> UTC -> Saturday
            ("no_zone_anywhere", "XXX", "EMP", ts),  # -> UTC
            ("no_country", "AMS", "NOC", ts),  # dropped
            ("unknown_destination", "AMS", "ZZZ", ts),  # dropped
        ],
    )
    assert got == {
        "origin_zone": ("United States", "Sunday", "Summer"),
        "unknown_origin": ("Tokyo", "Sunday", "Summer"),
        "empty_origin_zone": ("Tokyo", "Sunday", "Summer"),
        "invalid_origin_zone": ("Tokyo", "Saturday", "Summer"),
        "no_zone_anywhere": ("Nowhere Land", "Saturday", "Summer"),
    }


def test_destination_zone_mode(spark):
    got = _enrich(spark, [("p", "AMS", "JFK", T(2019, 6, 15, 22))], tz_from="destination")
    assert got == {"p": ("United States", "Saturday", "Summer")}


def test_bounded_broadcast_falls_back_to_shuffle(spark):
    from paxflow.plans import sizing

    dim = clean_airports(parse_airport_lines(lines_df(spark, AIRPORTS)))
    small = sizing.bounded_broadcast(dim.select("iata"), max_rows=100)
    big = sizing.bounded_broadcast(dim.select("iata"), max_rows=2)
    legs = spark.createDataFrame([("p", "AMS", "JFK", T(2019, 6, 15))], LEG_DDL)
    hinted = legs.join(small, legs.destination_airport == small.iata)._jdf.queryExecution().optimizedPlan().toString()
    plain = legs.join(big, legs.destination_airport == big.iata)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted.lower()
    assert "broadcast" not in plain.lower()


def test_unknown_destinations(spark):
    dim = clean_airports(parse_airport_lines(lines_df(spark, AIRPORTS)))
    legs = spark.createDataFrame(
        [("a", "AMS", "JFK", T(2019, 6, 15)), ("b", "AMS", "NOC", T(2019, 6, 15)), ("c", "AMS", "ZZZ", T(2019, 6, 15)), ("d", "AMS", "ZZZ", T(2019, 6, 16))],
        LEG_DDL,
    )
    got = {r.destination_airport: r.legs for r in unknown_destinations(legs, dim).collect()}
    assert got == {"NOC": 1, "ZZZ": 2}
