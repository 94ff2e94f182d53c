"""Booking events: text scan -> typed events -> passenger-leg table.

S1/S2 scan, S4 fixed-schema JSON decode, S5 malformed records, S6 strict
validation, S7 record projection, S8 passenger x product flatten with a
single generator, S9 required fields, S10 timestamps, E6 normalisation.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.functions.instants import departure_window, utc_instant
from paxflow.schema import BOOKING_EVENT_DDL, LEG_COLUMNS, LEG_EVENT_DDL

RECORD = "event.DataElement.travelrecord"


def read_booking_lines(spark: SparkSession, path, glob: str | None = "*.json") -> DataFrame:
    """Raw text scan (column ``value``) of a file or directory.

    Only files matching ``glob`` are taken, directories are not descended.
    A missing path raises Spark's PATH_NOT_FOUND. Lines are never collected.
    """
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def read_booking_events(
    spark: SparkSession, path, glob: str | None = "*.json", skip_unreadable: bool = False, with_file: bool = False
) -> DataFrame:
    """JSON file scan with the declared schema (one parse per
    line, inside the scan; only the fields a query uses are converted).

    Columns: ``timestamp``, ``event``, ``_corrupt_record``. Blank lines are
    skipped, lines that are not JSON keep their text in ``_corrupt_record``.
    ``skip_unreadable``: a file that cannot be read on (a damaged archive)
    ends there and the scan goes on; what came before the damage is kept. By
    default it ends the run. ``with_file`` adds each line's ``file``;
    :mod:`paxflow.sources.ingest` finds the skipped files with it.
    """
    reader = spark.read.schema(BOOKING_EVENT_DDL).options(**_JSON_OPTIONS)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", "true")
    events = reader.json(path)
    return events.select("*", F.col("_metadata.file_path").alias("file")) if with_file else events


def decode(lines: DataFrame, ddl: str = BOOKING_EVENT_DDL) -> DataFrame:
    """S4 for a DataFrame of lines: same columns as
    :func:`read_booking_events` plus ``value``; never fails a job. ``ddl``
    may leave out members that are not used.

    The parsed struct leaves through a one-row ``inline`` generator: filters
    on its fields then stay above the generator instead of being pushed
    below it with ``from_json`` copied into them, so each line is parsed
    once (measured 25 % faster on sf0.1 than a plain projection). Blank lines
    give the generator nothing; as a filter the test would be pushed into what
    makes the lines, and make each line twice.
    """
    parsed = F.from_json("value", ddl, _JSON_OPTIONS)
    return lines.select("value", F.inline(F.when(F.trim(F.col("value")) != "", F.array(parsed))))


def decoded(df: DataFrame) -> DataFrame:
    """Accept either a lines DataFrame (``value``) or a decoded one."""
    return decode(df) if "event" not in df.columns else df


def whole_number(c: Column) -> Column:
    """Text (or JSON number read as text) -> INT, null when not an integer."""
    return c.try_cast("int")


def _passenger_ok(p: Column) -> Column:
    age_ok = p.age.isNull() | whole_number(p.age).isNotNull()
    return p.isNotNull() & p.uci.isNotNull() & p.passengerType.isNotNull() & whole_number(p.tattoo).isNotNull() & age_ok


def _product_ok(d: Column) -> Column:
    f = d.flight
    return (
        d.isNotNull()
        & d.bookingStatus.isNotNull()
        & f.isNotNull()
        & f.originAirport.isNotNull()
        & f.destinationAirport.isNotNull()
        & f.operatingAirline.isNotNull()
        & utc_instant(f.departureDate).isNotNull()
        & utc_instant(f.arrivalDate).isNotNull()
    )


def event_reject_reason(strict: bool) -> Column:
    """Why an event is rejected, or null when it is kept."""
    record = F.col(RECORD)
    reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed_json")).when(
        record.isNull(), F.lit("missing_travelrecord")
    )
    if strict:
        bad_member = F.exists(record.passengersList, lambda p: ~_passenger_ok(p)) | F.exists(
            record.productsList, lambda d: ~_product_ok(d)
        )
        empty = (F.coalesce(F.size(record.passengersList), F.lit(-1)) <= 0) | (
            F.coalesce(F.size(record.productsList), F.lit(-1)) <= 0
        )
        reason = (
            reason.when(empty, F.lit("empty_travelrecord"))
            .when(bad_member, F.lit("invalid_member"))
            .when(utc_instant("timestamp").isNull(), F.lit("invalid_timestamp"))
        )
    return reason


def _null_marks(record: Column) -> list[Column]:
    """Which members of an event are null, as columns that are never null."""

    def bits(*fields: Column) -> Column:
        marks = [F.when(f.isNull(), F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fields)]
        return functools.reduce(lambda a, b: a + b, marks)

    def flight(d: Column) -> list[Column]:
        f = d.flight
        return [f, f.originAirport, f.destinationAirport, f.departureDate, f.arrivalDate, f.operatingAirline]

    none = F.array(F.lit(-1))
    passengers = F.transform(record.passengersList, lambda p: bits(p, p.uci, p.passengerType, p.age, p.tattoo))
    products = F.transform(record.productsList, lambda d: bits(d, d.bookingStatus, *flight(d)))
    return [F.coalesce(passengers, none), F.coalesce(products, none), F.col("timestamp").isNull()]


def _event_columns(record: Column, origins=None) -> list[Column]:
    passengers = F.transform(
        F.filter(record.passengersList, lambda p: p.isNotNull()),
        lambda p: F.struct(
            p.uci.alias("uci"),
            F.upper(F.trim(p.passengerType)).alias("passenger_type"),
            whole_number(p.age).alias("age"),
            whole_number(p.tattoo).alias("tattoo"),
        ),
    )
    def keep(d: Column) -> Column:
        cond = d.isNotNull() & d.flight.isNotNull()
        return cond & d.flight.originAirport.isin(*origins) if origins is not None else cond

    products = F.transform(
        F.filter(record.productsList, keep),
        lambda d: F.struct(
            F.upper(F.trim(d.bookingStatus)).alias("booking_status"),
            d.flight.originAirport.alias("origin_airport"),
            d.flight.destinationAirport.alias("destination_airport"),
            utc_instant(d.flight.departureDate).alias("departure_ts"),
            utc_instant(d.flight.arrivalDate).alias("arrival_ts"),
            d.flight.operatingAirline.alias("operating_airline"),
        ),
    )
    # Hashes skip nulls, so that a value which moves to a neighbouring null
    # field would keep the id; which fields are null is hashed as well.
    parts = [F.col("timestamp"), record.passengersList, record.productsList, *_null_marks(record)]
    return [
        F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(7), *parts).alias("h2")).alias("event_id"),
        utc_instant("timestamp").alias("booking_ts"),
        passengers.alias("passengers"),
        products.alias("products"),
    ]


def parse_events(source: DataFrame, strict: bool = False, origins=None) -> DataFrame:
    """Valid booking events with normalised, typed members.

    ``source`` is a decoded scan (:func:`read_booking_events`) or a
    DataFrame of lines. Columns: event_id (two independent 64-bit hashes
    of the parsed event), booking_ts (TIMESTAMP_NTZ, UTC), passengers,
    products. Rejected lines are available from :func:`quarantine`.
    ``origins`` keeps only products departing from those codes (a key
    predicate for leg pipelines: dates of other products are not parsed).
    """
    raw = decoded(source)
    return raw.filter(event_reject_reason(strict).isNull()).select(*_event_columns(F.col(RECORD), origins))


def event_text(raw: DataFrame) -> Column:
    """The text of a rejected event: the line, what is left of a malformed
    one, or the event written as JSON again."""
    if "value" in raw.columns:
        return F.col("value")
    return F.coalesce(F.col("_corrupt_record"), F.to_json(F.struct("timestamp", "event")))


def quarantine(source: DataFrame, strict: bool = False) -> DataFrame:
    """Rejected lines with a reason (value, reason). From a file
    scan the text of a malformed line is kept; other rejects are
    re-serialised from the parsed event."""
    raw = decoded(source)
    return raw.select(event_text(raw).alias("value"), event_reject_reason(strict).alias("reason")).filter(F.col("reason").isNotNull())


def product_key_filter(origins=None, start=None, end=None):
    """Predicate on a product struct using only leg-key fields.

    Applied inside the flatten lambda it removes legs *before* the
    generator, which Catalyst cannot do by itself (filters are not pushed
    below Generate). Only key fields may be used here: a whole latest-status
    group is then kept or dropped together, so the result is unchanged.
    """
    def pred(d: Column) -> Column:
        cond = F.lit(True)
        if origins is not None:
            cond = cond & d.origin_airport.isin(*origins)
        if start is not None or end is not None:
            cond = cond & departure_window(d.departure_ts, start, end)
        return cond

    return pred


def explode_legs(events: DataFrame, product_filter=None, keep_event_id: bool = False) -> DataFrame:
    """One row per event x passenger x product, in one generator.

    Passengers without uci and products without origin, destination,
    airline or parsable departure/arrival are dropped (row level, D5).
    """

    def product_ok(d: Column) -> Column:
        cond = (
            d.origin_airport.isNotNull()
            & d.destination_airport.isNotNull()
            & d.operating_airline.isNotNull()
            & d.departure_ts.isNotNull()
            & d.arrival_ts.isNotNull()
        )
        return cond & product_filter(d) if product_filter is not None else cond

    legs = F.flatten(
        F.transform(
            F.filter("passengers", lambda p: p.uci.isNotNull()),
            lambda p: F.transform(
                F.filter("products", product_ok),
                lambda d: F.struct(
                    F.col("booking_ts").alias("booking_ts"),
                    p.uci.alias("passenger_uci"),
                    p.passenger_type.alias("passenger_type"),
                    p.age.alias("passenger_age"),
                    d.booking_status.alias("booking_status"),
                    d.origin_airport.alias("origin_airport"),
                    d.destination_airport.alias("destination_airport"),
                    d.operating_airline.alias("operating_airline"),
                    d.departure_ts.alias("departure_ts"),
                    d.arrival_ts.alias("arrival_ts"),
                ),
            ),
        )
    )
    cols = ["event_id"] if keep_event_id else []
    return events.select(*cols, F.inline(legs))


def feed_legs(source: DataFrame, strict: bool = False, origins=None, start=None, end=None) -> DataFrame:
    """The legs of ``explode_legs(parse_events(...))`` with the given
    key rules, for pipelines that need no whole events.

    Products and passengers leave one generator each, so times are parsed per
    product row by generated code and not by lambdas, which Spark interprets.
    """
    # no leg has a tattoo, only the strict rules read it
    raw = source if "event" in source.columns else decode(source, BOOKING_EVENT_DDL if strict else LEG_EVENT_DDL)
    raw = raw.filter(event_reject_reason(strict).isNull())
    record, f = F.col(RECORD), F.col("flight")
    events = raw.select(utc_instant("timestamp").alias("booking_ts"), record.passengersList.alias("_passengers"), record.productsList.alias("_products"))
    products = events.select("booking_ts", "_passengers", F.inline("_products"))
    named = f.originAirport.isNotNull() & f.destinationAirport.isNotNull() & f.operatingAirline.isNotNull()
    products = products.filter(named if origins is None else named & f.originAirport.isin(*origins))
    timed = F.struct(
        F.upper(F.trim("bookingStatus")).alias("booking_status"),
        f.originAirport.alias("origin_airport"),
        f.destinationAirport.alias("destination_airport"),
        f.operatingAirline.alias("operating_airline"),
        utc_instant(f.departureDate).alias("departure_ts"),
        utc_instant(f.arrivalDate).alias("arrival_ts"),
    )
    # a one-row generator again: the tests below read the parsed times
    products = products.select("booking_ts", "_passengers", F.inline(F.array(timed)))
    kept = F.col("departure_ts").isNotNull() & F.col("arrival_ts").isNotNull() & departure_window("departure_ts", start, end)
    pairs = products.filter(kept).select("*", F.inline("_passengers")).filter(F.col("uci").isNotNull())
    passenger = {
        "passenger_uci": F.col("uci"),
        "passenger_type": F.upper(F.trim("passengerType")),
        "passenger_age": whole_number(F.col("age")),
    }
    return pairs.select(*[passenger.get(c, F.col(c)).alias(c) for c in LEG_COLUMNS])


def pair_reject_reason(p: Column, d: Column, departs: Column, arrives: Column) -> Column:
    """Why a passenger x product pair is no leg, or null when it is one."""
    f = d.flight
    return (
        F.when(p.isNull(), "missing_passenger")
        .when(p.uci.isNull(), "missing_uci")
        .when(d.isNull() | f.isNull(), "missing_product")
        .when(f.originAirport.isNull(), "missing_origin")
        .when(f.destinationAirport.isNull(), "missing_destination")
        .when(f.operatingAirline.isNull(), "missing_airline")
        .when(departs.isNull(), "invalid_departure")
        .when(arrives.isNull(), "invalid_arrival")
    )


def quarantine_legs(source: DataFrame) -> DataFrame:
    """S5/S9 at leg level: every passenger x product pair of a kept event
    that gives no leg (booking_ts, reason, passenger, product as JSON text
    of the fields as they were read).

    Reasons, first that applies: missing_passenger, missing_uci,
    missing_product, missing_origin, missing_destination, missing_airline,
    invalid_departure, invalid_arrival. Legs and these rows together are
    all passenger x product pairs of the events that :func:`parse_events` keeps.
    """
    raw = decoded(source).filter(event_reject_reason(False).isNull())
    rows = member_pairs(raw.select(utc_instant("timestamp").alias("booking_ts"), F.col(RECORD).alias("record")))
    why = pair_reject_reason(F.col("p"), F.col("d"), F.col("departs"), F.col("arrives"))
    rejected = rows.filter("is_pair").withColumn("reason", why).filter(F.col("reason").isNotNull())
    return rejected.select("booking_ts", "reason", member_text("p").alias("passenger"), member_text("d").alias("product"))


def member_pairs(events: DataFrame) -> DataFrame:
    """Every passenger x product pair of the events (columns ``record`` and
    others, which stay): ``p``, ``d`` as they were read, ``departs``,
    ``arrives``. An event without pairs, or without a record, gives one row
    where ``is_pair`` is false. One generator; its lambdas only pair members,
    and times are parsed on its rows, by generated code."""
    kept = [F.col(c) for c in events.columns if c != "record"]
    record = F.col("record")
    pair = lambda p: F.transform(record.productsList, lambda d: F.struct(F.lit(True).alias("is_pair"), p.alias("p"), d.alias("d")))
    rows = events.select(*kept, F.inline_outer(F.flatten(F.transform(record.passengersList, pair))))
    f = F.col("d").flight
    times = [utc_instant(f.departureDate).alias("departs"), utc_instant(f.arrivalDate).alias("arrives")]
    return rows.select(*kept, F.coalesce("is_pair", F.lit(False)).alias("is_pair"), "p", "d", *times)


def member_text(member: str) -> Column:
    """A passenger or product as JSON text of the fields as they were read."""
    return F.to_json(F.struct(F.col(member).alias("v")), {"ignoreNullFields": "false"})


def legs_from_lines(source: DataFrame, strict: bool = False, product_filter=None) -> DataFrame:
    """S3: booking lines (or a decoded scan) -> passenger-leg table."""
    if product_filter is None:
        return feed_legs(source, strict)
    return explode_legs(parse_events(source, strict=strict), product_filter=product_filter)
