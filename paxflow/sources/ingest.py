"""One pass over a feed, several outputs.

Every line of the feed is parsed once and gives one or more outcomes: a leg,
a passenger x product pair that is no leg, an event without pairs, or an event
that is rejected. One generator tags them and one write stores them, parted by
outcome (and legs by departure month), so that the report, both quarantines,
the unknown airports and the list of unreadable files read small Parquet
columns and never the feed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paxflow.functions.instants import departure_window, utc_instant
from paxflow.plans.sizing import shared_dir
from paxflow.schema import LEG_COLUMNS
from paxflow.sources.bookings import (
    RECORD,
    decoded,
    event_reject_reason,
    event_text,
    member_pairs,
    member_text,
    pair_reject_reason,
    read_booking_events,
    whole_number,
)

LEG, LEG_REJECT, EVENT_REJECT, NO_PAIRS = "leg", "leg_reject", "event_reject", "no_pairs"
MONTH = "departure_month"

_FIELDS = (
    "reason STRING, value STRING, passenger STRING, product STRING, booking_ts TIMESTAMP_NTZ, passenger_uci STRING, "
    "passenger_type STRING, passenger_age INT, booking_status STRING, origin_airport STRING, destination_airport STRING, "
    "operating_airline STRING, departure_ts TIMESTAMP_NTZ, arrival_ts TIMESTAMP_NTZ"
)
OUTCOME_DDL = f"outcome STRING, {_FIELDS}"
_TYPES = dict(f.strip().split(" ") for f in OUTCOME_DDL.split(","))


def outcomes(source: DataFrame, strict: bool = False) -> DataFrame:
    """All outcomes of a decoded scan or of lines: ``file`` (null where the
    scan did not ask for it) and the columns of OUTCOME_DDL. Kept pairs,
    rejected pairs, rejected events and events without pairs account for
    every line that is not blank."""
    events = decoded(source)
    why_event = event_reject_reason(strict)
    file = F.col("file") if "file" in events.columns else F.lit(None).cast("string").alias("file")
    # a rejected event has no record here, and so no pairs
    told = events.select(
        file,
        why_event.alias("why_event"),
        F.when(why_event.isNotNull(), event_text(events)).alias("value"),
        F.when(why_event.isNull(), utc_instant("timestamp")).alias("booked"),
        F.when(why_event.isNull(), F.col(RECORD)).alias("record"),
    )
    p, d = F.col("p"), F.col("d")
    why_pair = F.when(F.col("is_pair"), pair_reject_reason(p, d, F.col("departs"), F.col("arrives")))
    rows = member_pairs(told).withColumn("why_pair", why_pair)
    why, paired, flight = F.col("why_pair"), F.col("is_pair"), d.flight
    kind = F.when(F.col("why_event").isNotNull(), EVENT_REJECT).when(~paired, NO_PAIRS).when(why.isNull(), LEG).otherwise(LEG_REJECT)
    values = {
        "outcome": kind,
        "reason": F.coalesce("why_event", "why_pair"),
        "value": F.col("value"),
        # the members as they were read, of rejected pairs only
        "passenger": F.when(why.isNotNull(), member_text("p")),
        "product": F.when(why.isNotNull(), member_text("d")),
        "booking_ts": F.col("booked"),
        "passenger_uci": p.uci,
        "passenger_type": F.upper(F.trim(p.passengerType)),
        "passenger_age": whole_number(p.age),
        "booking_status": F.upper(F.trim(d.bookingStatus)),
        "origin_airport": flight.originAirport,
        "destination_airport": flight.destinationAirport,
        "operating_airline": flight.operatingAirline,
        "departure_ts": F.col("departs"),
        "arrival_ts": F.col("arrives"),
    }
    return rows.select("file", *[values[name].cast(kind_of).alias(name) for name, kind_of in _TYPES.items()])


@dataclass(frozen=True)
class Ingested:
    """Outcomes stored at ``path``, parted by outcome and departure month."""

    spark: SparkSession
    path: str

    def rows(self, outcome: str | None = None) -> DataFrame:
        table = self.spark.read.schema(f"file STRING, {_FIELDS}, outcome STRING, {MONTH} DATE").parquet(self.path)
        return table if outcome is None else table.filter(F.col("outcome") == outcome)

    def legs(self, start=None, end=None) -> DataFrame:
        """Kept legs; a departure range opens its months only."""
        legs = self.rows(LEG).filter(departure_window("departure_ts", start, end))
        if start is not None:
            legs = legs.filter(F.col(MONTH) >= F.lit(start.replace(day=1)))
        if end is not None:
            legs = legs.filter(F.col(MONTH) <= F.lit(end.replace(day=1)))
        return legs.select(*LEG_COLUMNS)

    def event_rejects(self) -> DataFrame:
        return self.rows(EVENT_REJECT).select("value", "reason")

    def leg_rejects(self) -> DataFrame:
        return self.rows(LEG_REJECT).select("booking_ts", "reason", "passenger", "product")

    def rejects(self) -> DataFrame:
        """Both kinds, for one quarantine: ``level`` tells them apart."""
        events = self.event_rejects().withColumn("level", F.lit("event"))
        return events.unionByName(self.leg_rejects().withColumn("level", F.lit("leg")), allowMissingColumns=True)

    def counts(self) -> DataFrame:
        """Rows per outcome and reason (null for legs)."""
        return self.rows().groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("row_count"))

    def skipped(self, listing: DataFrame) -> DataFrame:
        """Files of ``listing`` (see :func:`booking_files`) that have content
        but gave not a single line."""
        seen = self.rows().select("file").distinct()
        return listing.filter("length > 0").join(seen, "file", "left_anti")


def booking_files(spark: SparkSession, path, glob: str | None = "*.json") -> DataFrame:
    """The files that a scan of ``path`` takes: ``file``, ``length``. Their
    contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"), "length")


def store_outcomes(source: DataFrame, strict: bool = False, path: str | None = None) -> Ingested:
    """Parse ``source`` once and store every outcome. Rows are spread by
    outcome and month; AQE splits whatever is large among them."""
    spark = source.sparkSession
    path = path or shared_dir(spark, "ingest")
    month = F.when(F.col("outcome") == LEG, F.trunc(F.col("departure_ts").cast("date"), "month"))
    tagged = outcomes(source, strict).withColumn(MONTH, month).hint("rebalance", "outcome", MONTH)
    tagged.write.mode("overwrite").partitionBy("outcome", MONTH).parquet(path)
    return Ingested(spark, path)


def ingest_files(
    spark: SparkSession, path, glob: str | None = "*.json", strict: bool = False, skip_unreadable: bool = False, to: str | None = None
) -> Ingested:
    """Booking files stored as outcomes. With ``skip_unreadable`` a file that
    breaks (a damaged archive, say) ends where it breaks instead of ending the
    run; ``skipped`` then names those that gave nothing."""
    events = read_booking_events(spark, path, glob, skip_unreadable=skip_unreadable, with_file=True)
    return store_outcomes(events, strict, to)
