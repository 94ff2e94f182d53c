"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching DuckDB SQL. Every query starts from the driver's tables through
the bridge (paxflow.sources.tables) and runs over all rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.config import RuleConfig
from paxflow.functions.text import code_list
from paxflow.operators import enrich as en
from paxflow.operators import report as rp
from paxflow.operators import rules as ru
from paxflow.operators.status import latest_status, latest_status_agg
from paxflow.plans import oracle as q
from paxflow.plans.pipeline import observed_report, report_from_legs, rule_legs
from paxflow.schema import LEG_COLUMNS
from paxflow.sources import airports as ap
from paxflow.sources import bookings as bk
from paxflow.sources import tables as tb

# Fixed parameters of the registered queries.
REPORT_CFG = RuleConfig(start=dt.date(1995, 1, 1), end=dt.date(1998, 12, 31))
_EMPTY_CFG = RuleConfig(start=dt.date(2031, 1, 1), end=dt.date(2031, 12, 31))
EVENT_CFG = RuleConfig(start=dt.date(1996, 1, 1), end=dt.date(1996, 6, 30))
LEG_RANGE = (dt.date(1996, 1, 1), dt.date(1996, 12, 31))
EVENT_RANGE = (dt.date(1996, 1, 1), dt.date(1996, 3, 31))
EVENT_ORIGINS = ("N05", "N10", "AMS")
ONE_DAY = dt.date(1996, 3, 15)
CODES_TEXT = " ams, Ein ,RTM,, grq "
HOME = "Netherlands"

LEG_SQL = ", ".join(LEG_COLUMNS)


# ------------------------------------------------------------------ inputs


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return tb.booking_lines(spark, sf)


def events(spark: SparkSession, sf: str, strict: bool = False) -> DataFrame:
    return bk.parse_events(lines(spark, sf), strict=strict)


def legs(spark: SparkSession, sf: str) -> DataFrame:
    return bk.feed_legs(lines(spark, sf))


def airports(spark: SparkSession, sf: str) -> DataFrame:
    return ap.clean_airports(ap.parse_airport_lines(tb.airport_lines(spark, sf)))


def event_view(ev: DataFrame) -> DataFrame:
    """Comparable projection of an event."""
    out, ret = F.get("products", 0), F.get("products", 1)
    return ev.select(
        "booking_ts",
        F.get("passengers", 0).uci.alias("lead_uci"),
        F.size("passengers").alias("n_passengers"),
        out.origin_airport.alias("out_origin"),
        out.departure_ts.alias("out_departure_ts"),
        ret.departure_ts.alias("ret_departure_ts"),
    )


EVENT_SQL = "booking_ts, lead_uci, n_passengers, out_origin, out_departure_ts, ret_departure_ts"

# ----------------------------------------------------------------- queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


@register("parse_legs", q.with_base() + f"\nSELECT {LEG_SQL} FROM legs")
def parse_legs(spark, sf):
    """Raw lines -> passenger-leg table."""
    return legs(spark, sf)


@register(
    "first_destination",
    q.with_base() + "\nSELECT booking_ts, out_destination AS first_destination FROM events",
)
def first_destination(spark, sf):
    """First product's destination per event."""
    return ru.first_destination(events(spark, sf)).select("booking_ts", "first_destination")


@register(
    "origins_from_text",
    q.with_base()
    + "\nSELECT origin_airport, count(*) AS legs FROM legs "
    "WHERE origin_airport IN ('AMS', 'EIN', 'RTM', 'GRQ') GROUP BY origin_airport",
)
def origins_from_text(spark, sf):
    """Codes held as text are split/normalised in Spark and semi-joined."""
    codes = spark.createDataFrame([(CODES_TEXT,)], "codes STRING").select(
        F.explode(code_list("codes")).alias("iata")
    )
    picked = ru.departing_from(legs(spark, sf), codes)
    return picked.groupBy("origin_airport").agg(F.count(F.lit(1)).alias("legs"))


@register(
    "quarantine_counts",
    q.with_base(
        """bad AS (
  SELECT CASE WHEN k % 101 = 0 AND ln = 1 THEN 'malformed_json'
              WHEN k % 103 = 0 AND ln = 2 THEN 'missing_travelrecord'
              WHEN k % 109 = 0 AND ln = 3 THEN NULL
              WHEN k % 107 = 0 THEN 'invalid_member' END AS reason
  FROM src
)"""
    )
    + """
SELECT 'row' AS mode, reason, count(*) AS lines FROM bad
WHERE reason IN ('malformed_json', 'missing_travelrecord') GROUP BY reason
UNION ALL
SELECT 'strict' AS mode, reason, count(*) AS lines FROM bad WHERE reason IS NOT NULL GROUP BY reason""",
)
def quarantine_counts(spark, sf):
    """Rejected lines per reason, row-level and strict mode."""
    raw = lines(spark, sf)
    row = bk.quarantine(raw).withColumn("mode", F.lit("row"))
    strict = bk.quarantine(raw, strict=True).withColumn("mode", F.lit("strict"))
    return row.unionByName(strict).groupBy("mode", "reason").agg(F.count(F.lit(1)).alias("lines"))


@register("airports_clean", q.with_base() + "\nSELECT * FROM airports")
def airports_clean(spark, sf):
    """Parsed, defaulted, zone-guarded, one row per IATA."""
    return airports(spark, sf)


@register(
    "utc_offsets",
    q.with_base() + "\nSELECT iata, timezone_offset AS utc_offset_hours FROM airports",
)
def utc_offsets(spark, sf):
    """UTC offset per IATA code."""
    return ap.utc_offsets(airports(spark, sf))


@register(
    "event_date_any",
    q.with_base()
    + f"\nSELECT {EVENT_SQL} FROM events WHERE ({q.date_pred('out_departure_ts', *EVENT_RANGE)}) "
    f"OR ({q.date_pred('ret_departure_ts', *EVENT_RANGE)})",
)
def event_date_any(spark, sf):
    """any product departs in range."""
    return event_view(ru.any_departure_between(events(spark, sf), *EVENT_RANGE))


@register(
    "event_airline_any",
    q.with_base() + f"\nSELECT {EVENT_SQL} FROM events WHERE out_airline = 'DL' OR ret_airline = 'DL'",
)
def event_airline_any(spark, sf):
    """any product operated by DL (only return legs are)."""
    return event_view(ru.any_operated_by(events(spark, sf), "DL"))


@register(
    "event_origin_any",
    q.with_base()
    + f"\nSELECT {EVENT_SQL} FROM events WHERE out_origin IN ({q._in(EVENT_ORIGINS)}) "
    f"OR out_destination IN ({q._in(EVENT_ORIGINS)})",
)
def event_origin_any(spark, sf):
    """any product departs from one of the codes."""
    return event_view(ru.any_departing_from(events(spark, sf), EVENT_ORIGINS))


_CONFIRMED_EVENTS = """ev AS MATERIALIZED (
  SELECT row_number() OVER () AS eid, * FROM events
),
ev_keys AS (
  SELECT eid,
         CASE WHEN p = 1 THEN lead_uci ELSE 'C' || ck || '-2' END AS passenger_uci,
         CASE WHEN d = 1 THEN out_origin ELSE out_destination END AS origin_airport,
         CASE WHEN d = 1 THEN out_destination ELSE out_origin END AS destination_airport,
         CASE WHEN d = 1 THEN out_departure_ts ELSE ret_departure_ts END AS departure_ts
  FROM ev, (VALUES (1), (2)) ps(p), (VALUES (1), (2)) ds(d)
  WHERE (p = 1 AND lead_uci IS NOT NULL) OR (p = 2 AND ck % 3 = 0)
),
confirmed_events AS (
  SELECT * FROM ev WHERE eid IN (
    SELECT k.eid FROM ev_keys k
    JOIN latest t USING (passenger_uci, origin_airport, destination_airport, departure_ts)
    WHERE t.is_confirmed)
)"""


@register(
    "event_confirmed_semi",
    q.with_base(_CONFIRMED_EVENTS) + f"\nSELECT {EVENT_SQL} FROM confirmed_events",
)
def event_confirmed_semi(spark, sf):
    """F8: events holding at least one leg whose latest status is CONFIRMED."""
    return event_view(ru.confirmed_events(events(spark, sf)))


def _event_rules_where(cfg: RuleConfig) -> str:
    s, e = cfg.start, cfg.end
    return (
        f"(({q.date_pred('out_departure_ts', s, e)}) OR ({q.date_pred('ret_departure_ts', s, e)}))"
        f" AND (out_airline = '{cfg.airline}' OR ret_airline = '{cfg.airline}')"
        f" AND (out_origin IN ({q._in(cfg.origins)}) OR out_destination IN ({q._in(cfg.origins)}))"
    )


@register(
    "event_rules",
    q.with_base(_CONFIRMED_EVENTS)
    + f"\nSELECT {EVENT_SQL} FROM confirmed_events WHERE {_event_rules_where(EVENT_CFG)}",
)
def event_rules(spark, sf):
    """date, airline, origin, confirmed-leg tests, each over any product."""
    return event_view(ru.event_rules(events(spark, sf), EVENT_CFG))


@register(
    "qualifying_legs",
    q.with_base()
    + f"""
SELECT booking_ts, lead_uci, out_origin AS origin_airport, out_destination AS destination_airport,
       out_departure_ts AS departure_ts
FROM events
WHERE out_airline = '{EVENT_CFG.airline}' AND out_origin IN ({q._in(EVENT_CFG.origins)})
  AND out_status = 'CONFIRMED' AND {q.date_pred('out_departure_ts', EVENT_CFG.start, EVENT_CFG.end)}
UNION ALL
SELECT booking_ts, lead_uci, out_destination, out_origin, ret_departure_ts
FROM events
WHERE ret_airline = '{EVENT_CFG.airline}' AND out_destination IN ({q._in(EVENT_CFG.origins)})
  AND ret_status = 'CONFIRMED' AND {q.date_pred('ret_departure_ts', EVENT_CFG.start, EVENT_CFG.end)}""",
)
def qualifying_legs(spark, sf):
    """per event, the products that pass airline, origin, own status
    and date range."""
    ev = ru.qualifying_products(events(spark, sf), EVENT_CFG)
    return ev.select(
        "booking_ts", F.get("passengers", 0).uci.alias("lead_uci"), F.inline("products")
    ).select("booking_ts", "lead_uci", "origin_airport", "destination_airport", "departure_ts")


@register(
    "legs_in_range",
    q.with_base() + f"\nSELECT {LEG_SQL} FROM legs WHERE {q.date_pred('departure_ts', *LEG_RANGE)}",
)
def legs_in_range(spark, sf):
    """inclusive UTC departure date range."""
    return ru.departing_between(legs(spark, sf), *LEG_RANGE)


@register("legs_airline", q.with_base() + f"\nSELECT {LEG_SQL} FROM legs WHERE operating_airline = 'DL'")
def legs_airline(spark, sf):
    """operating airline."""
    return ru.operated_by(legs(spark, sf), "DL")


@register(
    "legs_origin",
    q.with_base() + f"\nSELECT {LEG_SQL} FROM legs WHERE origin_airport IN ({q._in(REPORT_CFG.origins)})",
)
def legs_origin(spark, sf):
    """origin in the default Dutch airport set."""
    return ru.departing_from(legs(spark, sf), REPORT_CFG.origins)


@register(
    "legs_from_country",
    q.with_base()
    + f"\nSELECT {LEG_SQL} FROM legs WHERE origin_airport IN (SELECT iata FROM airports WHERE country = '{HOME}')",
)
def legs_from_country(spark, sf):
    """F6 with J5: origins taken from the dimension by country (semi join)."""
    return ru.departing_from(legs(spark, sf), ap.country_airports(airports(spark, sf), HOME))


@register(
    "legs_confirmed_now",
    q.with_base() + f"\nSELECT {LEG_SQL} FROM legs WHERE booking_status = 'CONFIRMED'",
)
def legs_confirmed_now(spark, sf):
    """the row's own status."""
    return ru.confirmed_now(legs(spark, sf))


@register("latest_status", q.with_base() + "\nSELECT * FROM latest")
def latest_status_q(spark, sf):
    """Latest event per passenger-leg, CANCELLED wins ties."""
    return latest_status(legs(spark, sf))


@register("latest_status_confirmed_first", q.with_base() + "\nSELECT * FROM latest_cf")
def latest_status_cf(spark, sf):
    """CONFIRMED wins ties."""
    return latest_status(legs(spark, sf), tie_break="confirmed_first")


@register("latest_status_agg", q.with_base() + "\nSELECT * FROM latest")
def latest_status_agg_q(spark, sf):
    """The same answer from a min_by aggregate (stream-capable form)."""
    return latest_status_agg(legs(spark, sf))


@register(
    "rules_all",
    q.with_base(q.rules_cte("r", "latest", REPORT_CFG.start, REPORT_CFG.end)) + "\nSELECT * FROM r",
)
def rules_all(spark, sf):
    """latest -> confirmed -> date -> airline -> origin."""
    return ru.apply_rules(legs(spark, sf), REPORT_CFG)


@register(
    "country_airports",
    q.with_base() + f"\nSELECT iata FROM airports WHERE country = '{HOME}'",
)
def country_airports(spark, sf):
    """Airports of one country."""
    return ap.country_airports(airports(spark, sf), HOME)


@register(
    "unknown_airports",
    q.with_base()
    + "\nSELECT destination_airport, count(*) AS legs FROM legs "
    "WHERE destination_airport NOT IN (SELECT iata FROM airports WHERE country <> '') GROUP BY destination_airport",
)
def unknown_airports(spark, sf):
    """Destinations without a country, with leg counts (anti join)."""
    return en.unknown_destinations(legs(spark, sf), airports(spark, sf))


_ENRICH_SQL = f"{LEG_SQL}, is_confirmed, country, day_of_week, season"


@register(
    "enrich_origin_tz",
    q.with_base(q.enrich_cte("e", "latest", "origin")) + f"\nSELECT {_ENRICH_SQL} FROM e",
)
def enrich_origin_tz(spark, sf):
    """Day of week in the origin's zone with fallbacks."""
    return en.enrich(latest_status(legs(spark, sf)), airports(spark, sf), "origin")


@register(
    "enrich_destination_tz",
    q.with_base(q.enrich_cte("e", "latest", "destination")) + f"\nSELECT {_ENRICH_SQL} FROM e",
)
def enrich_destination_tz(spark, sf):
    """Day of week in the destination's zone."""
    return en.enrich(latest_status(legs(spark, sf)), airports(spark, sf), "destination")


def _report_sql(cfg: RuleConfig, latest_cte: str = "latest") -> list[str]:
    return [
        q.rules_cte("r", latest_cte, cfg.start, cfg.end, cfg.airline, cfg.origins),
        q.enrich_cte("e", "r", cfg.tz_from),
        q.report_cte("rep", "e"),
    ]


def _report(spark, sf, cfg: RuleConfig) -> DataFrame:
    return report_from_legs(rule_legs(lines(spark, sf), cfg), airports(spark, sf), cfg)


@register("passenger_report", q.with_base(*_report_sql(REPORT_CFG)) + "\nSELECT * FROM rep")
def passenger_report(spark, sf):
    """The core report (flagship)."""
    return _report(spark, sf, REPORT_CFG)


_FINAL_SQL = """SELECT country, day_of_week, season, passenger_count,
       NULLIF(adults_count, 0) AS adults_count, NULLIF(children_count, 0) AS children_count, average_age
FROM rep"""


@register("passenger_report_final", q.with_base(*_report_sql(REPORT_CFG)) + "\n" + _FINAL_SQL)
def passenger_report_final(spark, sf):
    """Report rows as delivered (zero counts -> null), ordered."""
    return rp.order_report(rp.report_rows(_report(spark, sf, REPORT_CFG)))


_DEST_CFG = REPORT_CFG.with_(tz_from="destination")
_CF_CFG = REPORT_CFG.with_(tie_break="confirmed_first")


@register("passenger_report_destination_tz", q.with_base(*_report_sql(_DEST_CFG)) + "\nSELECT * FROM rep")
def passenger_report_destination_tz(spark, sf):
    """D1 variant: day of week in the destination's zone."""
    return _report(spark, sf, _DEST_CFG)


@register(
    "passenger_report_confirmed_first",
    q.with_base(*_report_sql(_CF_CFG, "latest_cf")) + "\nSELECT * FROM rep",
)
def passenger_report_confirmed_first(spark, sf):
    """D3 variant: CONFIRMED wins equal timestamps."""
    return _report(spark, sf, _CF_CFG)


@register(
    "report_top10",
    q.with_base(*_report_sql(REPORT_CFG))
    + "\nSELECT * FROM rep ORDER BY passenger_count DESC, season, day_of_week, country LIMIT 10",
)
def report_top10(spark, sf):
    """O2: first ten rows of the ordered report."""
    return rp.top_n(_report(spark, sf, REPORT_CFG), 10)


@register(
    "report_rank_by_season_day",
    q.with_base(*_report_sql(REPORT_CFG))
    + "\nSELECT *, CAST(rank() OVER (PARTITION BY season, day_of_week ORDER BY passenger_count DESC) AS INTEGER) AS rank"
    "\nFROM rep QUALIFY rank <= 3",
)
def report_rank_by_season_day(spark, sf):
    """Top 3 countries inside each (season, day of week), ties kept."""
    return rp.rank_within_season_day(_report(spark, sf, REPORT_CFG), 3)


_DAY_CFG = REPORT_CFG.with_(start=ONE_DAY, end=ONE_DAY)


@register(
    "day_top_countries",
    q.with_base(*_report_sql(_DAY_CFG)[:2])
    + "\nSELECT country, count(*) AS passengers FROM e GROUP BY country"
    "\nORDER BY passengers DESC, country LIMIT 10",
)
def day_top_countries(spark, sf):
    """A6, O3, ST6: passengers per country on one UTC day (deduplicated)."""
    enriched = en.enrich(
        ru.apply_rules(rule_legs(lines(spark, sf), _DAY_CFG), _DAY_CFG), airports(spark, sf), _DAY_CFG.tz_from
    )
    return rp.top_countries(rp.day_country_counts(enriched, ONE_DAY), n=10)


_RAW_DAY_SQL = f"""
SELECT a.country, CAST(sum(n) AS BIGINT) AS passengers
FROM (
  SELECT out_destination AS dest,
         (CASE WHEN lead_uci IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN ck % 3 = 0 THEN 1 ELSE 0 END) AS n
  FROM confirmed_events
  WHERE out_airline = 'KL' AND out_origin IN ({q._in(REPORT_CFG.origins)}) AND out_status = 'CONFIRMED'
    AND {q.date_pred('out_departure_ts', ONE_DAY, ONE_DAY)}
  UNION ALL
  SELECT out_origin,
         (CASE WHEN lead_uci IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN ck % 3 = 0 THEN 1 ELSE 0 END)
  FROM confirmed_events
  WHERE ret_airline = 'KL' AND out_destination IN ({q._in(REPORT_CFG.origins)}) AND ret_status = 'CONFIRMED'
    AND {q.date_pred('ret_departure_ts', ONE_DAY, ONE_DAY)}
) x
JOIN airports a ON a.iata = x.dest AND a.country <> ''
GROUP BY a.country
ORDER BY passengers DESC, a.country LIMIT 10"""


@register("day_top_countries_raw", q.with_base(_CONFIRMED_EVENTS) + _RAW_DAY_SQL)
def day_top_countries_raw(spark, sf):
    """A6 as counted per event: the event-level pre-filter (any product in
    the day, KL, origin, a confirmed latest leg), then +1 per passenger per
    qualifying product per event, without deduplication."""
    ev = events(spark, sf)
    pre = ru.event_rules(ev, _DAY_CFG)
    qual = ru.qualifying_products(pre, _DAY_CFG)
    rows = qual.select(
        F.inline(
            F.flatten(
                F.transform(
                    F.filter("passengers", lambda p: p.uci.isNotNull()),
                    lambda p: F.transform("products", lambda d: d.withField("passenger_uci", p.uci)),
                )
            )
        )
    )
    enriched = en.enrich(rows, airports(spark, sf), _DAY_CFG.tz_from)
    counts = rp.day_country_counts(enriched, ONE_DAY, distinct=False)
    return rp.top_countries(counts, n=10)


@register(
    "daily_country_counts",
    q.with_base(*_report_sql(REPORT_CFG)[:2])
    + "\nSELECT date_trunc('day', departure_ts) AS window_start, date_trunc('day', departure_ts) + INTERVAL 1 DAY AS window_end,"
    "\n       country, count(*) AS bookings FROM e GROUP BY ALL",
)
def daily_country_counts(spark, sf):
    """A7, ST4: one-day tumbling windows per destination country."""
    enriched = en.enrich(
        ru.apply_rules(rule_legs(lines(spark, sf), REPORT_CFG), REPORT_CFG), airports(spark, sf), REPORT_CFG.tz_from
    )
    return rp.daily_country_counts(enriched)


_TOP_DAY_SQL = """
SELECT departure_day, country, passengers FROM (
  SELECT CAST(departure_ts AS DATE) AS departure_day, country, count(*) AS passengers FROM e GROUP BY ALL
) QUALIFY rank() OVER (PARTITION BY departure_day ORDER BY passengers DESC) = 1"""


@register("top_country_per_day", q.with_base(*_report_sql(REPORT_CFG)[:2]) + _TOP_DAY_SQL)
def top_country_per_day_q(spark, sf):
    """ST7 (batch form): the top destination country of every UTC day."""
    enriched = en.enrich(
        ru.apply_rules(rule_legs(lines(spark, sf), REPORT_CFG), REPORT_CFG), airports(spark, sf), REPORT_CFG.tz_from
    )
    return rp.top_country_per_day(enriched)


STREAM_FILES_PER_TRIGGER = 4
# Files that a feed is replayed from, at most. Every trigger meets the state of all triggers before
# it, so their number must not grow with the feed; the files grow instead.
REPLAY_FILES = 16
SINGLE_REPLAY_FILES = 12  # where a trigger takes one file


def _replay_files(spark, sf, purpose: str) -> str:
    """Booking lines written as packed .json files under the shared folder (the
    text itself is many times the tables), as many files as the lines have
    partitions, but at most REPLAY_FILES."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import write_lines

    path = shared_dir(spark, purpose)
    write_lines(lines(spark, sf).coalesce(REPLAY_FILES), f"{path}/in", compression="lz4")
    return path


def _replayed_lines(spark, path: str) -> DataFrame:
    """The stream of what :func:`_replay_files` has written."""
    from paxflow.streaming import stream as st

    return st.stream_lines(spark, f"{path}/in", STREAM_FILES_PER_TRIGGER, "*.json.lz4", dealt=True)


@register("stream_top_countries", q.with_base(*_report_sql(REPORT_CFG)[:2]) + _TOP_DAY_SQL)
def stream_top_countries(spark, sf):
    """S14, ST1-ST7: the lines replayed as a file stream, a few files
    per trigger, latest status kept in the state store (cancellations
    retract), then the top country per day. Must equal the batch answer."""
    from paxflow.streaming import stream as st

    base = _replay_files(spark, sf, "stream-top")
    legs_s = st.stream_legs(_replayed_lines(spark, base), REPORT_CFG)
    query = st.start_leg_state(legs_s, f"{base}/state", f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    return st.top_countries_from_state(spark, f"{base}/state", airports(spark, sf), REPORT_CFG)


_NO_DATES_CFG = RuleConfig()
_OUTLIER_LINE = (
    '{"timestamp":"1992-01-01T00:00:00Z","event":{"DataElement":{"travelrecord":{"passengersList":[{"uci":"OUTLIER",'
    '"passengerType":"ADT","age":1,"tattoo":1}],"productsList":[{"bookingStatus":"CONFIRMED","flight":{"originAirport":"EIN",'
    '"destinationAirport":"AMS","departureDate":"2999-01-01","arrivalDate":"2999-01-01","operatingAirline":"KL"}}]}}}}'
)


@register(
    "stream_late_and_outlier",
    q.with_base(*_report_sql(_NO_DATES_CFG)[:2]) + _TOP_DAY_SQL + "\nUNION ALL SELECT DATE '2999-01-01', 'Netherlands', 1",
)
def stream_late_and_outlier(spark, sf):
    """ST3: a departure of the year 2999 arrives in the first file; then the
    feed, whose files mix early and late bookings and cancellations. No
    cancellation may be lost: the answer equals the batch SQL."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import write_lines
    from paxflow.streaming import stream as st

    base = shared_dir(spark, "stream-late")
    write_lines(spark.createDataFrame([(_OUTLIER_LINE,)], "value STRING"), f"{base}/in", compression="lz4")
    write_lines(lines(spark, sf).coalesce(SINGLE_REPLAY_FILES), f"{base}/in", mode="append", compression="lz4")
    legs_s = st.stream_legs(st.stream_lines(spark, f"{base}/in", 1, "*.json.lz4", dealt=True), _NO_DATES_CFG)
    query = st.start_leg_state(legs_s, f"{base}/state", f"{base}/checkpoint", available_now=True, compact_every=2)
    query.awaitTermination()
    return st.top_countries_from_state(spark, f"{base}/state", airports(spark, sf), _NO_DATES_CFG)


_STREAM_COUNTS_SQL = f"""
SELECT date_trunc('day', departure_ts) AS window_start, date_trunc('day', departure_ts) + INTERVAL 1 DAY AS window_end,
       country, count(*) AS bookings
FROM e
WHERE booking_status = 'CONFIRMED' AND operating_airline = 'KL' AND origin_airport IN ({q._in(REPORT_CFG.origins)})
GROUP BY ALL"""


_STREAM_PLACED_SQL = f"""
SELECT *, row_number() OVER (ORDER BY bookings DESC, window_start, country) AS position FROM ({_STREAM_COUNTS_SQL})"""


@register("stream_daily_counts", q.with_base(q.enrich_cte("e", "legs", "origin")) + _STREAM_PLACED_SQL)
def stream_daily_counts(spark, sf):
    """A7/ST1/O4 literal streaming form: windowed count, complete mode,
    sorted busiest first (``position`` in that order)."""
    from paxflow.streaming import stream as st
    from paxflow.streaming.publish import read_published

    base = _replay_files(spark, sf, "stream-counts")
    cfg = RuleConfig()
    legs_s = st.stream_legs(_replayed_lines(spark, base))
    counts = st.daily_counts_stream(legs_s, airports(spark, sf), cfg)
    st.start_daily_counts(counts, f"{base}/out", f"{base}/checkpoint", available_now=True).awaitTermination()
    return read_published(spark, f"{base}/out")


_DAY_COUNT_SQL = "\nSELECT CAST(departure_ts AS DATE) AS departure_day, country, count(*) AS passengers FROM e GROUP BY ALL"


def _replayed_ledger(spark, feed: DataFrame, purpose: str, cfg: RuleConfig, compact_every: int, **more):
    """A ledger that has taken in all files of a stream of lines."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.streaming import stream as st
    from paxflow.streaming.ledger import Ledger

    base = shared_dir(spark, purpose)
    ledger = Ledger(spark, f"{base}/ledger", cfg, compact_every=compact_every)
    legs_s = st.stream_legs(feed, cfg)
    ledger.start(legs_s, f"{base}/checkpoint", available_now=True, **more).awaitTermination()
    return ledger


@register("stream_retract_counts", q.with_base(*_report_sql(REPORT_CFG)[:2]) + _DAY_COUNT_SQL)
def stream_retract_counts(spark, sf):
    """ST7: every trigger turns its changed legs into -1 / +1 on a (day,
    destination) count table; the sums equal the batch counts."""
    files = _replay_files(spark, sf, "stream-retract")
    ledger = _replayed_ledger(spark, _replayed_lines(spark, files), "retract", REPORT_CFG, 3)
    return ledger.countries(airports(spark, sf))


_LATE_LINE = (
    '{"timestamp":"1998-12-30T00:00:00Z","event":{"DataElement":{"travelrecord":{"passengersList":[{"uci":"SETTLED",'
    '"passengerType":"ADT","age":1,"tattoo":1}],"productsList":[{"bookingStatus":"%s","flight":{"originAirport":"EIN",'
    '"destinationAirport":"AMS","departureDate":"1992-01-01","arrivalDate":"1992-01-01","operatingAirline":"KL"}}]}}}}'
)


@register(
    "stream_evicted_state",
    q.with_base(*_report_sql(_NO_DATES_CFG)[:2]) + _DAY_COUNT_SQL + "\nUNION ALL SELECT DATE '2999-01-01', 'Netherlands', 1",
)
def stream_evicted_state(spark, sf):
    """ST3: months settle once the booking watermark has passed them. First a
    departure of the year 2999 and a passenger of 1992; then the feed, which
    settles 1992; then that passenger's cancellation. No result may change."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import write_lines
    from paxflow.streaming import stream as st

    base = shared_dir(spark, "stream-evicted")
    early = [(_OUTLIER_LINE,), (_LATE_LINE.replace("1998-12-30", "1991-12-30") % "CONFIRMED",)]
    write_lines(spark.createDataFrame(early, "value STRING"), f"{base}/in", compression="lz4")
    write_lines(lines(spark, sf).coalesce(SINGLE_REPLAY_FILES), f"{base}/in", mode="append", compression="lz4")
    write_lines(spark.createDataFrame([(_LATE_LINE % "CANCELLED",)], "value STRING"), f"{base}/in", mode="append", compression="lz4")
    feed = st.stream_lines(spark, f"{base}/in", 1, "*.json.lz4", dealt=True)
    return _replayed_ledger(spark, feed, "evicted", _NO_DATES_CFG, 2).countries(airports(spark, sf))


@register("stream_dimension_change", q.with_base(*_report_sql(REPORT_CFG)[:2]) + _DAY_COUNT_SQL)
def stream_dimension_change(spark, sf):
    """The stream starts with half of the airports; the rest arrive
    while it runs. The view after each batch uses the table of that moment,
    and the last one counts passengers booked before their airport was known."""
    from paxflow.sources.sinks import write_lines

    base = _replay_files(spark, sf, "stream-dimension")
    table, later = f"{base}/airports", F.crc32(F.col("value").cast("binary")) % 2 == 0
    write_lines(tb.airport_lines(spark, sf).filter(~later), table, extension=".csv")

    def after(batch_id: int) -> None:
        if batch_id == 0:
            write_lines(tb.airport_lines(spark, sf).filter(later), table, extension=".csv", mode="append")

    ledger = _replayed_ledger(spark, _replayed_lines(spark, base), "dimension", REPORT_CFG, 100, after_batch=after)
    return ledger.countries(ap.read_airports(spark, table))


# Shares of a feed that is written as plain text, at most: one lies on disk at a time.
TEXT_SHARES = 16
SHARE_FILES = 8  # packed files of a share, at least: several tasks read it
LINES_PER_FILE = 100_000


def _feed_shares(spark, sf, path: str):
    """The booking lines, made once and kept packed below ``path``, share by
    share. A share is removed when the next one is asked for."""
    from paxflow.streaming.publish import Folder

    lines(spark, sf).write.option("compression", "zstd").option("maxRecordsPerFile", LINES_PER_FILE).parquet(path)
    folder = Folder(spark, path)
    files = [n for n in folder.names() if n.startswith("part-")]
    shares = max(1, min(TEXT_SHARES, len(files) // SHARE_FILES))
    for k in range(shares):
        yield spark.read.schema("value STRING").parquet(*[f"{path}/{n}" for n in files[k::shares]])
        for name in files[k::shares]:
            folder.remove(name)


@register("scan_roundtrip", q.with_base() + f"\nSELECT {LEG_SQL} FROM legs")
def scan_roundtrip(spark, sf):
    """Lines written as *.json files next to a decoy file of another
    name in the same folder, scanned back with the default *.json filter. The
    text is many times the tables, so a share of the lines takes this way at a
    time; the legs of all shares are kept."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import write_lines
    from paxflow.streaming.publish import Folder

    base = shared_dir(spark, "scan")
    path, kept = f"{base}/in", f"{base}/legs"
    decoy = spark.createDataFrame([(_DECOY_LINE,)], "value STRING")
    for share in _feed_shares(spark, sf, f"{base}/feed"):
        write_lines(share, path)
        # appended to the folder itself: only the name filter keeps its line, a valid event, out
        decoy.write.mode("append").text(path)
        legs_read = bk.feed_legs(bk.read_booking_events(spark, path))
        legs_read.write.mode("append").parquet(kept)
    Folder(spark, base).remove("in")
    return spark.read.schema(legs_read.schema).parquet(kept)


_DECOY_LINE = (
    '{"timestamp":"1995-01-01T00:00:00Z","event":{"DataElement":{"travelrecord":{"passengersList":[{"uci":"DECOY",'
    '"passengerType":"ADT","age":1,"tattoo":1}],"productsList":[{"bookingStatus":"CONFIRMED","flight":{"originAirport":"AMS",'
    '"destinationAirport":"EIN","departureDate":"1995-01-02","arrivalDate":"1995-01-02","operatingAirline":"KL"}}]}}}}'
)


@register(
    "ingest_outcomes",
    q.with_base()
    + """
SELECT 'leg' AS outcome, CAST(NULL AS VARCHAR) AS reason, count(*) AS row_count, count(DISTINCT passenger_uci) AS passengers FROM legs
UNION ALL SELECT 'leg_reject', 'missing_uci', 2 * count(*), 0 FROM valid WHERE k % 107 = 0
UNION ALL SELECT 'event_reject', 'malformed_json', count(*), 0 FROM src WHERE k % 101 = 0 AND ln = 1
UNION ALL SELECT 'event_reject', 'missing_travelrecord', count(*), 0 FROM src WHERE k % 103 = 0 AND ln = 2""",
)
def ingest_outcomes(spark, sf):
    """The feed parsed once into legs, leg rejects and event
    rejects; together they are all its lines and pairs."""
    from paxflow.sources.ingest import LEG, store_outcomes

    rows = store_outcomes(lines(spark, sf)).rows()
    uci = F.when(F.col("outcome") == LEG, F.col("passenger_uci"))
    return rows.groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(uci).alias("passengers"))


@register(
    "scan_skips_unreadable",
    q.with_base()
    + """
SELECT 'leg' AS kind, origin_airport AS name, count(*) AS row_count FROM legs GROUP BY origin_airport
UNION ALL SELECT 'skipped_file', 'broken.json.gz', 1""",
)
def scan_skips_unreadable(spark, sf):
    """A damaged archive among good files: the legs of the good ones, and the name of the one left out."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.ingest import booking_files, ingest_files
    from paxflow.sources.sinks import write_lines
    from paxflow.streaming.publish import Folder

    path, glob = shared_dir(spark, "scan-broken"), "*.json*"
    # packed, one file a partition: the text itself is many times the tables
    write_lines(lines(spark, sf), path, compression="gzip")
    Folder(spark, path).replace("broken.json.gz", "these bytes are no archive")
    feed = ingest_files(spark, path, glob, skip_unreadable=True)
    legs_kept = feed.legs().groupBy(F.lit("leg").alias("kind"), F.col("origin_airport").alias("name")).agg(F.count("*").alias("row_count"))
    name = F.element_at(F.split("file", "/"), -1).alias("name")
    skipped = feed.skipped(booking_files(spark, path, glob)).select(F.lit("skipped_file").alias("kind"), name, F.lit(1).cast("long").alias("row_count"))
    return legs_kept.unionByName(skipped)


def _written_report(spark, sf, name, fmt=None):
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import read_report, write_report

    path = f"{shared_dir(spark, 'report')}/{name}"
    write_report(rp.report_rows(_report(spark, sf, REPORT_CFG)), path, fmt)
    return read_report(spark, path, fmt)


@register("report_roundtrip", q.with_base(*_report_sql(REPORT_CFG)) + "\n" + _FINAL_SQL)
def report_roundtrip(spark, sf):
    """K1, K2, K5: the final report written as labelled CSV, read back with the declared schema."""
    return _written_report(spark, sf, "report.csv")


@register("report_roundtrip_json", q.with_base(*_report_sql(REPORT_CFG)) + "\n" + _FINAL_SQL)
def report_roundtrip_json(spark, sf):
    """K3, K5: the same as JSON lines."""
    return _written_report(spark, sf, "report.json")


_POSITION_SQL = f"""
SELECT *, row_number() OVER (ORDER BY passenger_count DESC, season, day_of_week, country) AS position FROM ({_FINAL_SQL})"""


@register("report_roundtrip_json_array", q.with_base(*_report_sql(REPORT_CFG)) + _POSITION_SQL)
def report_roundtrip_json_array(spark, sf):
    """K3, K4: the same as one JSON array; ``position`` is the place in the
    array, which must be the report order."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.sinks import REPORT_DDL, write_report

    path = f"{shared_dir(spark, 'report')}/array"
    write_report(rp.report_rows(_report(spark, sf, REPORT_CFG)), path, "json_array")
    fields = ",".join(c.replace(" ", ":", 1) for c in REPORT_DDL.split(", "))
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", f"array<struct<{fields}>>")))
    return rows.select("col.*", (F.col("pos") + 1).cast("long").alias("position"))


@register("empty_report", q.with_base(*_report_sql(_EMPTY_CFG)) + "\nSELECT * FROM rep")
def empty_report(spark, sf):
    """Q2: a departure range without departures gives an empty report."""
    return _report(spark, sf, _EMPTY_CFG)


@register(
    "quarantine_roundtrip",
    q.with_base() + "\nSELECT 'malformed_json' AS reason, count(*) AS rejects FROM src WHERE k % 101 = 0 AND ln = 1"
    "\nUNION ALL SELECT 'missing_travelrecord', count(*) FROM src WHERE k % 103 = 0 AND ln = 2",
)
def quarantine_roundtrip(spark, sf):
    """K7: rejects appended as JSON lines in two runs, read back and counted (half of the rows are one run's)."""
    from paxflow.plans.sizing import shared_dir, stored
    from paxflow.sources.sinks import write_quarantine

    path = shared_dir(spark, "rejects")
    # the feed is read once, for both runs
    rejects = stored(bk.quarantine(lines(spark, sf)), "rejects-found")
    write_quarantine(rejects.filter("reason = 'malformed_json'"), path)
    write_quarantine(rejects.filter("reason <> 'malformed_json'"), path)
    return spark.read.schema("value STRING, reason STRING").json(path).groupBy("reason").agg(F.count("*").alias("rejects"))


@register(
    "quarantine_legs",
    q.with_base() + "\nSELECT 'missing_uci' AS reason, 2 * count(*) AS legs FROM src"
    "\nWHERE k % 107 = 0 AND NOT (k % 101 = 0 AND ln = 1) AND NOT (k % 103 = 0 AND ln = 2) AND NOT (k % 109 = 0 AND ln = 3)",
)
def quarantine_legs_q(spark, sf):
    """Passenger x product pairs that give no leg, per reason."""
    return bk.quarantine_legs(lines(spark, sf)).groupBy("reason").agg(F.count("*").alias("legs"))


_STAGE_SQL = f"""
SELECT 'events' AS stage, count(*) AS row_count FROM events
UNION ALL SELECT 'legs', count(*) FROM legs
  WHERE origin_airport IN ({q._in(REPORT_CFG.origins)}) AND {q.date_pred("departure_ts", REPORT_CFG.start, REPORT_CFG.end)}
UNION ALL SELECT 'latest_confirmed', count(*) FROM r
UNION ALL SELECT 'enriched', count(*) FROM e
UNION ALL SELECT 'groups', count(*) FROM rep"""


@register("stage_counts", q.with_base(*_report_sql(REPORT_CFG)) + _STAGE_SQL)
def stage_counts(spark, sf):
    """Q1: row counts per stage, observed while the report itself is
    computed once (one parse of the feed, no count per stage)."""
    report, counts = observed_report(lines(spark, sf), airports(spark, sf), REPORT_CFG)
    report.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(counts.get().items()), "stage STRING, row_count BIGINT")


@register("passenger_report_from_store", q.with_base(*_report_sql(REPORT_CFG)) + "\nSELECT * FROM rep")
def passenger_report_from_store(spark, sf):
    """Legs stored once as month-partitioned Parquet, then the report read
    back with partition pruning and pushed filters."""
    from paxflow.plans.sizing import shared_dir
    from paxflow.sources.legstore import read_leg_store, write_leg_store

    path = shared_dir(spark, "legstore")
    write_leg_store(legs(spark, sf), path)
    stored = read_leg_store(spark, path, REPORT_CFG.start, REPORT_CFG.end, REPORT_CFG.origins)
    return report_from_legs(stored, airports(spark, sf), REPORT_CFG)


_STRICT_CFG = REPORT_CFG.with_(strict=True)


@register(
    "passenger_report_strict",
    q.with_base(*_report_sql(_STRICT_CFG, "latest_strict")) + "\nSELECT * FROM rep",
)
def passenger_report_strict(spark, sf):
    """D5/S6 variant: an event with any invalid member is dropped whole
    (here: every event whose main passenger has no uci loses its companion
    too)."""
    return _report(spark, sf, _STRICT_CFG)
