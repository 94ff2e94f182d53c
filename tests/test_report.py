"""Report aggregation, projection, ordering, top-k and rank."""

import datetime as dt

from golden import rows

from paxflow.operators import report as rp

ENRICHED_DDL = (
    "passenger_uci STRING, passenger_type STRING, passenger_age INT, origin_airport STRING, "
    "destination_airport STRING, departure_ts TIMESTAMP_NTZ, country STRING, day_of_week STRING, season STRING"
)
T = dt.datetime


NOON = T(2022, 2, 10, 12)  # a Thursday


def enriched(spark):
    """Three countries and two days; a tie in size, a group of infants without ages, a child among adults."""
    return spark.createDataFrame(
        [
            ("K1", "ADT", 71, "RTM", "OSL", NOON, "Norway", "Thursday", "Winter"),
            ("K2", "ADT", 18, "RTM", "OSL", NOON, "Norway", "Thursday", "Winter"),
            ("K3", "CHD", 11, "GRQ", "BGO", NOON, "Norway", "Thursday", "Winter"),
            ("K4", "INF", None, "RTM", "LIS", NOON, "Portugal", "Thursday", "Winter"),
            ("K5", "INF", None, "MST", "OPO", NOON, "Portugal", "Thursday", "Winter"),
            ("K6", "ADT", 27, "RTM", "LIS", T(2022, 2, 13, 6), "Portugal", "Sunday", "Winter"),
            ("K1", "ADT", 71, "RTM", "MLA", T(2022, 2, 13, 6), "Malta", "Sunday", "Winter"),
        ],
        ENRICHED_DDL,
    )


def test_groups_counts_average(spark):
    got = {(r.country, r.day_of_week): tuple(r)[3:] for r in rp.passenger_report(enriched(spark)).collect()}
    assert got == {
        ("Norway", "Thursday"): (3, 2, 1, 33.33),
        ("Portugal", "Thursday"): (2, 0, 0, None),
        ("Portugal", "Sunday"): (1, 1, 0, 27.0),
        ("Malta", "Sunday"): (1, 1, 0, 71.0),
    }


def test_report_rows_null_zero_counts_and_order(spark):
    out = rows(rp.order_report(rp.report_rows(rp.passenger_report(enriched(spark)))))
    assert out == [
        ("Norway", "Thursday", "Winter", 3, 2, 1, 33.33),
        ("Portugal", "Thursday", "Winter", 2, None, None, None),
        ("Malta", "Sunday", "Winter", 1, 1, None, 71.0),
        ("Portugal", "Sunday", "Winter", 1, 1, None, 27.0),
    ]


def test_average_rounds_half_up_exactly(spark):
    # 199 x age 1 and one age 2: 201 / 200 = 1.005 -> 1.01 (binary rounding gives 1.0)
    data = [(f"P{i}", "ADT", 1, "AMS", "JFK", T(2019, 4, 15), "US", "Monday", "Spring") for i in range(199)]
    data.append(("PX", "ADT", 2, "AMS", "JFK", T(2019, 4, 15), "US", "Monday", "Spring"))
    data.append(("PY", "INF", None, "AMS", "JFK", T(2019, 4, 15), "US", "Monday", "Spring"))
    r = rp.passenger_report(spark.createDataFrame(data, ENRICHED_DDL)).collect()[0]
    assert r.average_age == 1.01
    assert (r.passenger_count, r.adults_count, r.children_count) == (201, 200, 0)


def test_average_null_without_ages(spark):
    data = [("P", "ADT", None, "AMS", "JFK", T(2019, 4, 15), "US", "Monday", "Spring")]
    assert rp.passenger_report(spark.createDataFrame(data, ENRICHED_DDL)).collect()[0].average_age is None


def test_top_n_and_rank(spark):
    rep = rp.passenger_report(enriched(spark))
    assert [r.country for r in rp.top_n(rep, 3).collect()] == ["Norway", "Portugal", "Malta"]
    ranked = {(r.country, r.day_of_week): r["rank"] for r in rp.rank_within_season_day(rep).collect()}
    assert ranked == {("Norway", "Thursday"): 1, ("Portugal", "Thursday"): 2, ("Malta", "Sunday"): 1, ("Portugal", "Sunday"): 1}
    assert rp.rank_within_season_day(rep, 1).count() == 3


def test_day_counts_and_windows(spark):
    e = enriched(spark)
    day = {r.country: r.passengers for r in rp.day_country_counts(e, dt.date(2022, 2, 10)).collect()}
    assert day == {"Norway": 3, "Portugal": 2}
    dup = e.unionByName(e)
    assert {r.country: r.passengers for r in rp.day_country_counts(dup, dt.date(2022, 2, 10)).collect()} == day
    raw = rp.day_country_counts(dup, dt.date(2022, 2, 10), distinct=False)
    assert {r.country: r.passengers for r in raw.collect()} == {"Norway": 6, "Portugal": 4}
    win = {(r.window_start.day, r.country): r.bookings for r in rp.daily_country_counts(e).collect()}
    assert win == {(10, "Norway"): 3, (10, "Portugal"): 2, (13, "Portugal"): 1, (13, "Malta"): 1}
    top = sorted(rows(rp.top_country_per_day(e)))
    assert top == [(dt.date(2022, 2, 10), "Norway", 3), (dt.date(2022, 2, 13), "Malta", 1), (dt.date(2022, 2, 13), "Portugal", 1)]


def test_positions_over_many_partitions(spark):
    from pyspark.sql import functions as F

    from paxflow.plans.ordering import with_position

    rows = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 101).alias("a"), F.col("id").alias("b"), F.lit("x").alias("position_of"))
    placed = with_position(rows, [F.col("a").desc(), F.col("b").asc()])
    got = [(r.a, r.b) for r in placed.orderBy("position").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and [r.position for r in placed.orderBy("position").collect()] == list(range(1, 5001))
    assert with_position(rows.limit(0), [F.col("a").asc()]).count() == 0
    same = with_position(rows.select(F.lit(1).alias("a")), [F.col("a").asc()])
    assert sorted(r.position for r in same.collect()) == list(range(1, 5001))
