"""Business rules at leg level (F2, F4, F6, F7, F10) and event level
(F1, F3, F5, F8, F9, F11).

Leg-level rules act on the flattened table. Event-level rules keep event
granularity and test "any product" with higher-order functions, so
different products of one event may satisfy different predicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.config import CONFIRMED, RuleConfig
from paxflow.functions.instants import departure_window
from paxflow.operators.status import latest_status
from paxflow.plans.sizing import bounded_broadcast, shared_dir
from paxflow.schema import LEG_KEY

# ---------------------------------------------------------------- leg level


def departing_between(legs: DataFrame, start=None, end=None) -> DataFrame:
    """UTC departure date in [start, end], inclusive."""
    return legs.filter(departure_window("departure_ts", start, end))


def operated_by(legs: DataFrame, airline: str) -> DataFrame:
    """exact operating airline."""
    return legs.filter(F.col("operating_airline") == F.lit(airline))


def departing_from(legs: DataFrame, origins) -> DataFrame:
    """origin in a set of codes.

    A Python collection becomes an ``IN`` list (pushed into scans); a
    DataFrame of codes (column ``iata``) becomes a semi join, broadcast
    only when its size is checked to be small.
    """
    if isinstance(origins, DataFrame):
        codes = bounded_broadcast(origins.select(F.col("iata").alias("_origin")).distinct())
        return legs.join(codes, F.col("origin_airport") == F.col("_origin"), "left_semi")
    return legs.filter(F.col("origin_airport").isin(*origins))


def confirmed_now(legs: DataFrame) -> DataFrame:
    """the row's own status is CONFIRMED (not the latest status)."""
    return legs.filter(F.col("booking_status") == CONFIRMED)


def apply_rules(legs: DataFrame, cfg: RuleConfig) -> DataFrame:
    """latest status -> confirmed -> date -> airline -> origin.

    Date and origin are key columns, so Catalyst evaluates them below the
    window; airline and status are not and must stay above it.
    """
    latest = latest_status(legs, cfg.tie_break)
    kept = latest.filter(F.col("is_confirmed"))
    kept = departing_between(kept, cfg.start, cfg.end)
    kept = operated_by(kept, cfg.airline)
    return kept if cfg.origins is None else departing_from(kept, cfg.origins)


# -------------------------------------------------------------- event level


def _product_in_window(start, end):
    return lambda d: departure_window(d.departure_ts, start, end)


def any_departure_between(events: DataFrame, start=None, end=None) -> DataFrame:
    """keep the event if any product departs in [start, end]."""
    return events.filter(F.exists("products", _product_in_window(start, end)))


def any_operated_by(events: DataFrame, airline: str) -> DataFrame:
    """keep the event if any product is operated by ``airline``."""
    return events.filter(F.exists("products", lambda d: d.operating_airline == F.lit(airline)))


def any_departing_from(events: DataFrame, origins) -> DataFrame:
    """keep the event if any product departs from ``origins``."""
    return events.filter(F.exists("products", lambda d: d.origin_airport.isin(*origins)))


def _facts(tags: list[Column]) -> Column:
    """An event's legs as an array of narrow structs: ``tags``, the leg key
    and what decides the latest status. Legs need a complete key only;
    airline and arrival may be missing."""
    return F.flatten(
        F.transform(
            F.filter("passengers", lambda p: p.uci.isNotNull()),
            lambda p: F.transform(
                F.filter(
                    "products",
                    lambda d: d.origin_airport.isNotNull()
                    & d.destination_airport.isNotNull()
                    & d.departure_ts.isNotNull(),
                ),
                lambda d: F.struct(
                    *tags,
                    p.uci.alias("passenger_uci"),
                    p.passenger_type.alias("passenger_type"),
                    p.age.alias("passenger_age"),
                    d.booking_status.alias("booking_status"),
                    d.origin_airport.alias("origin_airport"),
                    d.destination_airport.alias("destination_airport"),
                    d.departure_ts.alias("departure_ts"),
                    d.arrival_ts.alias("arrival_ts"),
                    d.operating_airline.alias("operating_airline"),
                ),
            ),
        )
    )


def event_legs(events: DataFrame) -> DataFrame:
    """Every event's legs as narrow facts, one generator: event_id,
    booking_ts and the fields of a fact."""
    return events.select("event_id", "booking_ts", F.inline(_facts([])))


def facts_and_candidates(events: DataFrame, candidate: Column) -> tuple[DataFrame, DataFrame]:
    """(facts of all events, the candidate events whole), stored by one pass
    over ``events``: an event leaves the generator as its narrow legs, and a
    candidate once more as itself. Both carry ``row``, a number of the event
    within this store, where legs need no wider id. The two kinds lie in
    folders of their own, so neither reads the other's columns."""
    fields = event_legs(events).drop("event_id", "booking_ts").schema.fields
    facts = _facts([F.lit("fact").alias("kind"), F.lit(None).cast(events.schema).alias("event")])
    no_fact = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    itself = F.array(F.struct(F.lit("event").alias("kind"), F.struct(*events.columns).alias("event"), *no_fact))
    # computed below the generator, so once per event and not once per leg
    marked = events.withColumn("candidate", F.coalesce(candidate, F.lit(False))).withColumn("row", F.monotonically_increasing_id())
    both = F.concat(facts, F.filter(itself, lambda _: F.col("candidate")))
    rows = marked.select("row", "booking_ts", "candidate", F.inline(both))
    path = shared_dir(events.sparkSession, "event-facts")
    rows.write.partitionBy("kind").parquet(path)
    table = events.sparkSession.read.schema(rows.schema).parquet(path)
    return table.filter("kind = 'fact'").drop("kind", "event"), table.filter("kind = 'event'").select("row", "event.*")


def with_confirmed_leg(events: DataFrame, latest: DataFrame) -> DataFrame:
    """F8: events with at least one leg whose latest status is CONFIRMED.

    For a ``latest`` that comes from elsewhere; :func:`confirmed_events` has
    its own and reads the feed once. Event legs are semi-joined to the
    confirmed latest keys (shuffle on the leg key; AQE splits a skewed left
    side) and reduced to distinct event ids (partial aggregation first), which
    select the events. AQE turns either join into a broadcast where its
    runtime statistics allow it.
    """
    confirmed_keys = latest.filter(F.col("is_confirmed")).select(*LEG_KEY)
    ids = event_legs(events).join(confirmed_keys, list(LEG_KEY), "left_semi").select("event_id").distinct()
    return events.join(ids, "event_id", "left_semi")


def confirmed_events(events: DataFrame, tie_break: str = "cancelled_first") -> DataFrame:
    """F8 with the latest status of the same feed, which is parsed once:
    facts and whole events are stored together, the facts' latest status
    selects row numbers, and those select the stored events."""
    facts, whole = facts_and_candidates(events, F.lit(True))
    confirmed = _confirmed_keys(_complete(facts), tie_break)
    rows = facts.select("row", *LEG_KEY).join(confirmed, list(LEG_KEY), "left_semi").select("row").distinct()
    return whole.join(rows, "row", "left_semi").select(*events.columns)


def _complete(facts: DataFrame) -> DataFrame:
    """Facts that are legs: a latest status is that of a whole leg."""
    return facts.filter("operating_airline is not null and arrival_ts is not null").drop("row", "candidate")


def _confirmed_keys(legs: DataFrame, tie_break: str) -> DataFrame:
    return latest_status(legs, tie_break).filter(F.col("is_confirmed")).select(*LEG_KEY)


def first_destination(events: DataFrame) -> DataFrame:
    """Destination code of each event's first product (null when the
    event has no product)."""
    return events.withColumn("first_destination", F.get("products", 0).destination_airport)


def qualifying_product(cfg: RuleConfig):
    """F9 predicate on one product: airline, origin, own status CONFIRMED,
    and the date range only when both bounds are given."""

    def pred(d: Column) -> Column:
        cond = (d.operating_airline == F.lit(cfg.airline)) & (d.booking_status == CONFIRMED)
        if cfg.origins is not None:
            cond = cond & d.origin_airport.isin(*cfg.origins)
        if cfg.start is not None and cfg.end is not None:
            cond = cond & departure_window(d.departure_ts, cfg.start, cfg.end)
        return cond

    return pred


def qualifying_products(events: DataFrame, cfg: RuleConfig) -> DataFrame:
    """replace ``products`` by the products that qualify; events
    without any are dropped."""
    return events.withColumn("products", F.filter("products", qualifying_product(cfg))).filter(
        F.size("products") > 0
    )


def event_rules(events: DataFrame, cfg: RuleConfig) -> DataFrame:
    """date -> airline -> origin -> has a confirmed latest leg.

    Each test is "any product", so one product may satisfy the date and
    another the airline; :func:`qualifying_products` re-checks per product.

    The feed is parsed once: narrow facts of all events (id, key, status) and
    the candidates, events that pass the three tests, go to Parquet together.
    Latest status runs on the keys that candidates have, whole groups at a
    time, so it is exact for them. Those keys are sent to the facts where
    their number is checked to be small, so that only rows of asked legs are
    shuffled; else both sides are. Facts are not bucketed by key: a hot leg
    would be one bucket, which no join can split.
    """

    def passing(product) -> Column:
        return F.exists("products", product)

    candidate = passing(_product_in_window(cfg.start, cfg.end)) & passing(lambda d: d.operating_airline == F.lit(cfg.airline))
    if cfg.origins is not None:
        candidate = candidate & passing(lambda d: d.origin_airport.isin(*cfg.origins))
    facts, candidates = facts_and_candidates(events, candidate)
    asked = facts.filter("candidate").select("row", *LEG_KEY)
    keys = bounded_broadcast(asked.select(*LEG_KEY).distinct())
    confirmed = _confirmed_keys(_complete(facts).join(keys, list(LEG_KEY), "left_semi"), cfg.tie_break)
    rows = asked.join(confirmed, list(LEG_KEY), "left_semi").select("row").distinct()
    return candidates.join(rows, "row", "left_semi").select(*events.columns)
