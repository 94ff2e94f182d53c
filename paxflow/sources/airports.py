"""Airport dimension: headerless CSV -> one clean row per IATA code.

S11 scan, S12 null token and defaults, S13 key index (last row wins),
zone guard for the day-of-week expressions, J3-J5 lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.schema import AIRPORT_COLUMNS, AIRPORT_RAW_DDL

# The file's null token and the default of each field.
NULL_TOKEN = "\\N"
TEXT_DEFAULTS = {"name": "", "city": "", "country": "", "dst": "N", "tz_database": "UTC",
                 "airport_type": "unknown", "source": "Unknown"}
NUMERIC_FIELDS = {"airport_id": "INT", "latitude": "DOUBLE", "longitude": "DOUBLE",
                  "altitude": "INT", "timezone_offset": "DOUBLE"}


def parse_airport_lines(lines: DataFrame) -> DataFrame:
    """CSV text lines -> raw string columns plus ``_bad`` for rows that do
    not have exactly the 14 fields. Empty fields arrive as NULL, the null
    token as the literal ``\\N``, so the two stay distinguishable."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"'}
    # one-row generator: filters on the parsed fields stay above it, so
    # each line is parsed once (see bookings.decode)
    return lines.select(F.inline(F.array(F.from_csv("value", AIRPORT_RAW_DDL, opts))))


def read_airports(spark: SparkSession, path) -> DataFrame:
    """Scan an airport file or directory with the CSV source (one
    parse per line, in the scan) and return the clean dimension."""
    raw = (
        spark.read.schema(AIRPORT_RAW_DDL)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("escape", '"')
        .csv(path)
    )
    return clean_airports(raw)


def _token(c: str) -> Column:
    return F.col(c) == F.lit(NULL_TOKEN)


def valid_zone(zone: Column) -> Column:
    """True when Spark knows the zone id; uses Spark's own parser."""
    return F.try_to_timestamp(F.concat(F.lit("2000-01-01 00:00:00 "), zone)).isNotNull()


def clean_airports(raw: DataFrame) -> DataFrame:
    """Typed dimension keyed by IATA.

    Rows with fewer than 14 fields are skipped (extra trailing fields are
    allowed). ``\\N`` takes the field default, numbers that do not parse
    become 0. A zone is trimmed; an empty or
    blank one is empty (callers then fall back to another airport), an
    unknown one becomes UTC. On duplicate IATA codes the row
    with the highest airport_id wins.
    """
    kept = raw.filter(F.col("_bad").isNull() | F.col("source").isNotNull())
    cols = {}
    for c in AIRPORT_COLUMNS:
        if c in NUMERIC_FIELDS:
            cols[c] = F.coalesce(
                F.when(~_token(c), F.expr(f"try_cast(trim({c}) AS {NUMERIC_FIELDS[c]})")),
                F.lit(0).cast(NUMERIC_FIELDS[c].lower()),
            )
        elif c in ("iata", "icao"):
            cols[c] = F.when(_token(c), F.lit(None)).otherwise(F.coalesce(F.col(c), F.lit("")))
        else:
            cols[c] = F.when(_token(c), F.lit(TEXT_DEFAULTS[c])).otherwise(F.coalesce(F.col(c), F.lit("")))
    typed = kept.select(*[v.alias(k) for k, v in cols.items()])
    # The parser behind valid_zone trims, the conversions that use the zone do not.
    zone = F.trim(F.col("tz_database"))
    typed = typed.withColumn(
        "tz", F.when((zone == "") | valid_zone(zone), zone).otherwise(F.lit("UTC"))
    )
    rest = [c for c in typed.columns if c not in ("iata", "airport_id")]
    latest = F.max(F.struct("airport_id", *rest)).alias("a")
    return (
        typed.filter(F.col("iata").isNotNull() & (F.col("iata") != ""))
        .groupBy("iata")
        .agg(latest)
        .select("iata", "a.*")
    )


def country_of(airports: DataFrame) -> DataFrame:
    """J1 side: iata -> country (empty country dropped, D9)."""
    return airports.filter(F.col("country") != "").select("iata", "country")


def country_airports(airports: DataFrame, country: str) -> DataFrame:
    """IATA codes located in one country."""
    return airports.filter(F.col("country") == country).select("iata")


def utc_offsets(airports: DataFrame) -> DataFrame:
    """Iata -> numeric UTC offset in hours."""
    return airports.select("iata", F.col("timezone_offset").alias("utc_offset_hours"))
