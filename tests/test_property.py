"""Random booking histories: the Spark report equals a brute-force model.

The model below is written independently of the engine, straight from the
semantics in the README: latest event per (uci, origin, destination,
departure) with the tie rule, then status / date / airline / origin rules,
then country, zone day and season, then counts per group.
"""

import datetime as dt
import json
from collections import defaultdict
from zoneinfo import ZoneInfo

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from golden import lines_df

from paxflow.config import RuleConfig
from paxflow.plans.pipeline import report_from_lines
from paxflow.sources.airports import clean_airports, parse_airport_lines

AIRPORTS = {  # iata: (country, zone)
    "AMS": ("Netherlands", "Europe/Amsterdam"),
    "EIN": ("Netherlands", "Europe/Amsterdam"),
    "JFK": ("United States", "America/New_York"),
    "NRT": ("Japan", "Asia/Tokyo"),
    "SYD": ("Australia", "Australia/Sydney"),
}
AIRPORT_LINES = [
    f'{i},"{c}","x","{country}","{c}","X",0,0,0,0,E,"{zone}","airport","S"'
    for i, (c, (country, zone)) in enumerate(AIRPORTS.items(), start=1)
]
CODES = list(AIRPORTS) + ["ZZZ"]  # one unknown airport
BASE = dt.datetime(2019, 12, 30)
CFG = RuleConfig(start=dt.date(2019, 12, 31), end=dt.date(2020, 1, 2), origins=("AMS", "EIN", "ZZZ"))

product = st.tuples(
    st.sampled_from(["CONFIRMED", "confirmed", "CANCELLED", "WAITLISTED"]),
    st.sampled_from(CODES),
    st.sampled_from(CODES),
    st.integers(0, 4 * 24 - 1),  # departure hour offset from BASE
    st.sampled_from(["KL", "AF"]),
)
passenger = st.tuples(st.sampled_from(["U1", "U2", "U3"]), st.sampled_from(["ADT", "CHD", "INF"]), st.one_of(st.none(), st.integers(0, 99)))
event = st.tuples(st.integers(0, 3), st.lists(passenger, min_size=1, max_size=2), st.lists(product, min_size=1, max_size=3))


def to_line(ev):
    ts_min, pax, prods = ev
    ts = (BASE - dt.timedelta(days=30) + dt.timedelta(minutes=ts_min)).isoformat() + "Z"
    body = {
        "timestamp": ts,
        "event": {"DataElement": {"travelrecord": {
            "passengersList": [
                {"uci": u, "passengerType": t, **({"age": a} if a is not None else {}), "tattoo": 1} for u, t, a in pax
            ],
            "productsList": [
                {"bookingStatus": s, "flight": {
                    "originAirport": o, "destinationAirport": d,
                    "departureDate": (BASE + dt.timedelta(hours=h)).isoformat() + "Z",
                    "arrivalDate": (BASE + dt.timedelta(hours=h + 2)).isoformat() + "Z",
                    "operatingAirline": al}}
                for s, o, d, h, al in prods
            ],
        }}},
    }
    return json.dumps(body)


def model(events, cfg):
    latest = {}
    for ts_min, pax, prods in events:
        for u, t, a in pax:
            for s, o, d, h, al in prods:
                key = (u, o, d, h)
                row = (ts_min, s.upper(), al, t, a)
                # newest first; ties: status ascending, then airline, type, age (nulls last)
                rank = (-ts_min, s.upper(), al, t, 10**9 if a is None else a)
                if key not in latest or rank < latest[key][0]:
                    latest[key] = (rank, row)
    groups = defaultdict(list)
    for (u, o, d, h), (_, (ts_min, s, al, t, a)) in latest.items():
        dep = BASE + dt.timedelta(hours=h)
        if s != "CONFIRMED" or al != cfg.airline or o not in cfg.origins:
            continue
        if not (cfg.start <= dep.date() <= cfg.end):
            continue
        if d not in AIRPORTS:
            continue
        country, dzone = AIRPORTS[d]
        zone = AIRPORTS[o][1] if o in AIRPORTS else dzone
        day = dep.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).strftime("%A")
        season = {12: "Winter", 1: "Winter", 2: "Winter"}.get(dep.month, "other")
        groups[(country, day, season)].append((t, a))
    out = set()
    for (country, day, season), members in groups.items():
        ages = [a for _, a in members if a is not None]
        avg = None if not ages else (sum(ages) * 200 + len(ages)) // (len(ages) * 2) / 100
        out.add((country, day, season, len(members), sum(t == "ADT" for t, _ in members),
                 sum(t == "CHD" for t, _ in members), avg))
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=12))
def test_report_matches_model(spark, events):
    airports = clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))
    got = {tuple(r) for r in report_from_lines(lines_df(spark, [to_line(e) for e in events]), airports, CFG).collect()}
    assert got == model(events, CFG)
    for _, _, _, total, adults, children, _ in got:
        assert adults + children <= total


def event_model(events, cfg):
    """F11 by brute force: any product in the date range, any product of
    the airline, any product from an origin, and a leg whose latest
    status (over all events) is CONFIRMED."""
    latest = {}
    for ts_min, pax, prods in events:
        for u, t, a in pax:
            for s, o, d, h, al in prods:
                key = (u, o, d, h)
                rank = (-ts_min, s.upper(), al, t, 10**9 if a is None else a)
                if key not in latest or rank < latest[key][0]:
                    latest[key] = (rank, s.upper())
    out = []
    for ts_min, pax, prods in events:
        in_range = any(cfg.start <= (BASE + dt.timedelta(hours=h)).date() <= cfg.end for _, _, _, h, _ in prods)
        airline = any(al == cfg.airline for *_, al in prods)
        origin = any(o in cfg.origins for _, o, _, _, _ in prods)
        confirmed = any(latest[(u, o, d, h)][1] == "CONFIRMED" for u, _, _ in pax for _, o, d, h, _ in prods)
        if in_range and airline and origin and confirmed:
            out.append((ts_min, tuple(u for u, _, _ in pax), tuple((o, d, h) for _, o, d, h, _ in prods)))
    return sorted(out)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=10))
def test_event_rules_match_model(spark, events):
    from pyspark.sql import functions as F

    from paxflow.operators.rules import event_rules
    from paxflow.sources.bookings import parse_events

    got = event_rules(parse_events(lines_df(spark, [to_line(e) for e in events])), CFG).select(
        "booking_ts", F.transform("passengers", lambda p: p.uci).alias("u"), "products"
    )
    start = BASE - dt.timedelta(days=30)
    rows_ = sorted(
        (
            int((r.booking_ts - start).total_seconds() // 60),
            tuple(r.u),
            tuple((p.origin_airport, p.destination_airport, int((p.departure_ts - BASE).total_seconds() // 3600)) for p in r.products),
        )
        for r in got.collect()
    )
    assert rows_ == event_model(events, CFG)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=2, max_size=10), st.randoms(use_true_random=False))
def test_stream_replay_equals_batch(spark, scratch, events, rnd):
    from golden import write_files

    from paxflow.streaming import stream as streaming

    airports = clean_airports(parse_airport_lines(lines_df(spark, AIRPORT_LINES)))
    lines = [to_line(e) for e in events]
    batch = {tuple(r) for r in report_from_lines(lines_df(spark, lines), airports, CFG).collect()}
    shuffled = lines[:]
    rnd.shuffle(shuffled)
    base = scratch("prop-stream")
    write_files(spark, f"{base}/in", shuffled, one_per_line=True)
    legs = streaming.stream_legs(streaming.stream_lines(spark, f"{base}/in", 3), CFG)
    streaming.start_leg_state(legs, f"{base}/state", f"{base}/ckpt", available_now=True).awaitTermination()
    got = {tuple(r) for r in streaming.report_from_state(spark, f"{base}/state", airports, CFG).collect()}
    assert got == batch
