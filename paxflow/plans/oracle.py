"""Reference answers as DuckDB SQL computed straight from the tables.

Nothing here parses JSON: the SQL applies the bridge mapping
(paxflow.sources.tables) and the report semantics directly, so agreement
with the Spark plans (which parse the generated lines) checks ingest,
latest status, rules, enrichment and aggregation end to end.
"""

from __future__ import annotations

import datetime as dt

from paxflow.config import DEFAULT_ORIGINS
from paxflow.sources.tables import ORIGIN_BY_ORDER, ZONE_BY_REGION


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _ts(day: dt.date) -> str:
    return f"TIMESTAMP '{day.isoformat()} 00:00:00'"


def date_pred(col: str, start: dt.date | None, end: dt.date | None) -> str:
    parts = []
    if start is not None:
        parts.append(f"{col} >= {_ts(start)}")
    if end is not None:
        parts.append(f"{col} < {_ts(end + dt.timedelta(days=1))}")
    return " AND ".join(parts) if parts else "TRUE"


_ORIGIN = "CASE k % 4 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(ORIGIN_BY_ORDER[:3])) + f" ELSE '{ORIGIN_BY_ORDER[3]}' END"
_ZONE = "CASE n_regionkey " + " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONE_BY_REGION)) + " END"
_SEASON = (
    "CASE WHEN month({c}) IN (12, 1, 2) THEN 'Winter' WHEN month({c}) IN (3, 4, 5) THEN 'Spring' "
    "WHEN month({c}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
)
_LATEST_ORDER = (
    "booking_ts DESC NULLS LAST, {extra}booking_status ASC NULLS FIRST, operating_airline ASC NULLS LAST, "
    "arrival_ts ASC NULLS LAST, passenger_type ASC NULLS LAST, passenger_age ASC NULLS LAST"
)
_KEY = "passenger_uci, origin_airport, destination_airport, departure_ts"

# One row per passenger slot (main, companion) x product slot (outbound,
# return) of every event in {source}.
_LEGS_BODY = """  SELECT ets AS booking_ts,
         CASE WHEN p = 1 THEN 'C' || ck ELSE 'C' || ck || '-2' END AS passenger_uci,
         CASE WHEN p = 2 OR ck % 7 = 0 THEN 'CHD' ELSE 'ADT' END AS passenger_type,
         CAST(CASE WHEN p = 2 THEN ck % 12 WHEN ck % 11 = 0 THEN NULL ELSE ck % 90 END AS INTEGER) AS passenger_age,
         CASE WHEN d = 1 THEN (CASE WHEN rf = 'R' THEN 'CANCELLED' ELSE 'CONFIRMED' END)
              ELSE (CASE WHEN rf = 'A' THEN 'CANCELLED' ELSE 'CONFIRMED' END) END AS booking_status,
         CASE WHEN d = 1 THEN org ELSE dst END AS origin_airport,
         CASE WHEN d = 1 THEN dst ELSE org END AS destination_airport,
         CASE WHEN d = 1 THEN (CASE WHEN k % 5 = 0 THEN 'AF' ELSE 'KL' END)
              ELSE (CASE WHEN k % 3 = 0 THEN 'DL' ELSE 'KL' END) END AS operating_airline,
         CASE WHEN d = 1 THEN dep ELSE rdep END AS departure_ts,
         CASE WHEN d = 1 THEN dep ELSE rdep END + to_hours(1 + k % 11) AS arrival_ts
  FROM {source}, (VALUES (1), (2)) ps(p), (VALUES (1), (2)) ds(d)
  WHERE (p = 1 AND k % 107 <> 0) OR (p = 2 AND ck % 3 = 0)
"""

BASE = f"""
src AS (
  SELECT o.o_orderkey AS k, l.l_linenumber AS ln, l.l_returnflag AS rf, l.l_linestatus AS ls,
         l.l_shipdate + to_seconds(CAST(l.l_linenumber AS BIGINT)) AS ets,
         o.o_orderdate + to_hours(o.o_orderkey % 24) AS dep,
         c.c_custkey AS ck, c.c_nationkey AS nk
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
valid AS (
  SELECT *, {_ORIGIN} AS org, 'N' || lpad(CAST(nk AS VARCHAR), 2, '0') AS dst,
         dep + to_hours(24 * (2 + k % 9) + k % 7) AS rdep
  FROM src
  WHERE NOT (k % 101 = 0 AND ln = 1) AND NOT (k % 103 = 0 AND ln = 2) AND NOT (k % 109 = 0 AND ln = 3)
),
events AS (
  SELECT ets AS booking_ts,
         CASE WHEN k % 107 = 0 THEN NULL ELSE 'C' || ck END AS lead_uci,
         CASE WHEN ck % 3 = 0 THEN 2 ELSE 1 END AS n_passengers,
         org AS out_origin, dst AS out_destination, dep AS out_departure_ts,
         CASE WHEN k % 5 = 0 THEN 'AF' ELSE 'KL' END AS out_airline,
         CASE WHEN rf = 'R' THEN 'CANCELLED' ELSE 'CONFIRMED' END AS out_status,
         rdep AS ret_departure_ts,
         CASE WHEN k % 3 = 0 THEN 'DL' ELSE 'KL' END AS ret_airline,
         CASE WHEN rf = 'A' THEN 'CANCELLED' ELSE 'CONFIRMED' END AS ret_status,
         k, ck
  FROM valid
),
legs AS (
{_LEGS_BODY.format(source='valid')}
),
legs_strict AS (
{_LEGS_BODY.format(source='(SELECT * FROM valid WHERE k % 107 <> 0) v')}
),
latest AS (
  SELECT *, booking_status = 'CONFIRMED' AS is_confirmed FROM legs
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_LATEST_ORDER.format(extra='')}) = 1
),
latest_strict AS (
  SELECT *, booking_status = 'CONFIRMED' AS is_confirmed FROM legs_strict
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_LATEST_ORDER.format(extra='')}) = 1
),
latest_cf AS (
  SELECT *, booking_status = 'CONFIRMED' AS is_confirmed FROM legs
  QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {_LATEST_ORDER.format(extra="CASE WHEN booking_status = 'CONFIRMED' THEN 0 ELSE 1 END, ")}) = 1
),
airports_raw AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iata, 100 + n_nationkey AS airport_id,
         'Airport ' || n_name AS name, 'City ' || n_nationkey AS city,
         CASE WHEN n_nationkey = 21 THEN '' ELSE n_name END AS country,
         'XN' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS icao,
         CAST(CASE WHEN n_nationkey = 18 THEN 0 ELSE n_nationkey * 1.5 END AS DOUBLE) AS latitude,
         CAST(n_regionkey * 10.25 AS DOUBLE) AS longitude,
         CAST(CASE WHEN n_nationkey = 18 THEN 0 ELSE n_nationkey * 10 END AS INTEGER) AS altitude,
         CAST(n_regionkey - 2 AS DOUBLE) AS timezone_offset, 'E' AS dst,
         CASE WHEN n_nationkey = 22 THEN '' WHEN n_nationkey = 23 THEN 'Invalid/Zone'
              WHEN n_nationkey = 24 THEN 'UTC' ELSE {_ZONE} END AS tz_database,
         'airport' AS airport_type, 'derived' AS source
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), 300, 'Airport ' || n_name || ' New',
         'City ' || n_nationkey, n_name, 'XN' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'),
         CAST(n_nationkey * 1.5 AS DOUBLE), CAST(n_regionkey * 10.25 AS DOUBLE),
         CAST(n_nationkey * 10 AS INTEGER), CAST(n_regionkey - 2 AS DOUBLE), 'E', 'Pacific/Auckland', 'airport', 'derived'
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 19
  UNION ALL
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), 50, 'Airport ' || n_name || ' Old',
         'City ' || n_nationkey, 'Shadow Country', 'XN' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0'),
         CAST(n_nationkey * 1.5 AS DOUBLE), CAST(n_regionkey * 10.25 AS DOUBLE),
         CAST(n_nationkey * 10 AS INTEGER), CAST(n_regionkey - 2 AS DOUBLE), 'E', 'Asia/Tokyo', 'airport', 'derived'
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 20
  UNION ALL
  SELECT * FROM (VALUES
    ('AMS', 1, 'Amsterdam Airport Schiphol', 'Amsterdam', 'Netherlands', 'EHAM', CAST(52.308601 AS DOUBLE), CAST(4.76389 AS DOUBLE), -11, 1.0::DOUBLE, 'E', 'Europe/Amsterdam', 'airport', 'OurAirports'),
    ('EIN', 2, 'Eindhoven Airport', 'Eindhoven', 'Netherlands', 'EHEH', CAST(51.4500999451 AS DOUBLE), CAST(5.37452983856 AS DOUBLE), 74, 1.0::DOUBLE, 'E', 'Europe/Amsterdam', 'airport', 'OurAirports'),
    ('RTM', 3, 'Rotterdam The Hague Airport', 'Rotterdam', 'Netherlands', 'EHRD', CAST(51.956902 AS DOUBLE), CAST(4.43722 AS DOUBLE), -15, 1.0::DOUBLE, 'E', 'Europe/Amsterdam', 'airport', 'OurAirports'),
    ('JFK', 4, 'John F Kennedy International Airport', 'New York', 'United States', 'KJFK', CAST(40.63980103 AS DOUBLE), CAST(-73.77890015 AS DOUBLE), 13, -5.0::DOUBLE, 'A', 'America/New_York', 'airport', 'OurAirports')
  ) t(iata, airport_id, name, city, country, icao, latitude, longitude, altitude, timezone_offset, dst, tz_database, airport_type, source)
),
airports AS (
  SELECT iata, CAST(airport_id AS INTEGER) AS airport_id, name, city, country, icao, latitude, longitude,
         CAST(altitude AS INTEGER) AS altitude, timezone_offset, dst, tz_database, airport_type, source,
         CASE WHEN tz_database = 'Invalid/Zone' THEN 'UTC' ELSE tz_database END AS tz
  FROM airports_raw
  QUALIFY row_number() OVER (PARTITION BY iata ORDER BY airport_id DESC) = 1
)"""


def with_base(*extra_ctes: str) -> str:
    """``WITH`` clause holding the shared CTEs plus query-specific ones."""
    return "WITH " + ",\n".join([BASE.strip()] + [c.strip() for c in extra_ctes])


def enrich_cte(name: str, source: str, tz_from: str = "origin") -> str:
    if tz_from == "origin":
        zone = "COALESCE(NULLIF(o.tz, ''), NULLIF(d.tz, ''), 'UTC')"
        org_join = "LEFT JOIN airports o ON l.origin_airport = o.iata"
    else:
        zone = "COALESCE(NULLIF(d.tz, ''), 'UTC')"
        org_join = ""
    return f"""{name} AS (
  SELECT l.*, d.country,
         dayname(timezone({zone}, timezone('UTC', l.departure_ts))) AS day_of_week,
         {_SEASON.format(c='l.departure_ts')} AS season
  FROM {source} l
  JOIN airports d ON l.destination_airport = d.iata AND d.country <> ''
  {org_join}
)"""


def rules_cte(name: str, source: str, start=None, end=None, airline="KL", origins=DEFAULT_ORIGINS) -> str:
    return f"""{name} AS (
  SELECT * FROM {source}
  WHERE is_confirmed AND {date_pred('departure_ts', start, end)}
    AND operating_airline = '{airline}' AND origin_airport IN ({_in(origins)})
)"""


def report_select(source: str) -> str:
    return f"""SELECT country, day_of_week, season,
       count(*) AS passenger_count,
       count(*) FILTER (WHERE passenger_type = 'ADT') AS adults_count,
       count(*) FILTER (WHERE passenger_type = 'CHD') AS children_count,
       CASE WHEN count(passenger_age) > 0 THEN
         CAST((sum(passenger_age) * 200 + count(passenger_age)) // (count(passenger_age) * 2) AS DOUBLE) / 100
       END AS average_age
FROM {source} GROUP BY country, day_of_week, season"""


def report_cte(name: str, source: str) -> str:
    return f"{name} AS (\n{report_select(source)}\n)"
