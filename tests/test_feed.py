"""Legs and outcomes from generators, the bridge's lines, UTC times."""

import pytest
from pyspark.sql import functions as F

from paxflow.functions.instants import _from_micros, instant_micros, utc_instant
from paxflow.schema import LEG_COLUMNS
from paxflow.sources import tables as tb
from paxflow.sources.bookings import explode_legs, feed_legs, parse_events, quarantine_legs

TEXTS = [
    "2020-01-02T03:04:05Z", "2020-01-01T00:00:0NZ", "2020-01-01T00:00+01Z", "2020-01-01T00+01:00Z", "2020-13-01T00:00:00Z", " 2020-01-02T03:04:05Z ",
    "2020-01-02T03:04:05.5Z", "2020-01-02T03:04:05+02:00", "2020-01-02 03:04:05Z", "2020-01-02T03:04:0ZZ", "0001-01-01T00:00:00Z", "12:00:00Z", "", None,
]


def product(origin="AMS", departs="2020-01-02T03:04:05Z"):
    return (
        f'{{"bookingStatus":" confirmed","flight":{{"originAirport":"{origin}","destinationAirport":"EIN",'
        f'"departureDate":"{departs}","arrivalDate":"2020-01-02T05:00:00+01:00","operatingAirline":"KL"}}}}'
    )


def line(passengers, products):
    record = f'{{"passengersList":{passengers},"productsList":{products}}}'
    return f'{{"timestamp":"2020-01-01T00:00:00Z","event":{{"DataElement":{{"travelrecord":{record}}}}}}}'


P = '{"uci":"A","passengerType":"adt","age":"x","tattoo":1}'
LINES = [
    line(f"[{P},null,{{}}]", f"[{product()},null,{{}},{product('EIN', 'never')}]"), line("[]", f"[{product()},{product()}]"), line(f"[{P}]", "[]"),
    line("null", "null"), line(f"[{P}]", f"[{product()}]"), line(f"[{P}]", f"[{product()}]"), "{cut", "", "  ", '{"timestamp":"2020-01-01T00:00:00Z","event":{}}',
]


def bag(df):
    return sorted(map(str, df.collect()))


def feed(spark):
    return spark.createDataFrame([(v,) for v in [*LINES, None]], "value STRING")


def test_plain_utc_text_reads_as_the_general_parser_does(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t STRING")
    rows = df.select("t", utc_instant("t").alias("a"), _from_micros(instant_micros("t")).alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]


def test_the_form_of_a_time_is_tested_once(spark):
    odd = ["2020-01-02T03:04:05Z\n", "\n2020-01-02T03:04:05", "2020-01-02x03:04:05Z", "12020-01-02T03:04:5Z", "+020-01-02T03:04:05Z", "2020-01-02 03:04:05z", "\u0662020-01-02T03:04:05Z"]
    df = spark.createDataFrame([(t,) for t in odd], "t STRING")
    rows = df.select("t", utc_instant("t").alias("a"), _from_micros(instant_micros("t")).alias("b")).collect()
    assert [(r.t, r.a) for r in rows] == [(r.t, r.b) for r in rows]
    plan = df.select(utc_instant("t").alias("a"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("substring(") == 1  # the one that is parsed; none per separator


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("origins", [None, ("AMS",)])
def test_legs_from_generators_are_the_exploded_events(spark, strict, origins):
    want = explode_legs(parse_events(feed(spark), strict=strict, origins=origins)).select(*LEG_COLUMNS)
    got = feed_legs(feed(spark), strict, origins)
    assert bag(got) == bag(want)
    assert "lambdafunction" not in feed_legs(feed(spark))._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_legs_and_rejects_account_for_each_other(spark):
    from paxflow.sources.ingest import outcomes

    kinds = {r["outcome"]: r["count"] for r in outcomes(feed(spark)).groupBy("outcome").count().collect()}
    assert kinds == {"leg": 3, "leg_reject": 11, "no_pairs": 3, "event_reject": 2}
    assert quarantine_legs(feed(spark)).count() == 11
    assert feed_legs(feed(spark)).count() == 3


def test_bridge_writes_an_order_once_and_leaves_null_members_out(spark, scratch):
    base = scratch("bridge")
    spark.sql(
        "select * from values (1L,1,'R','F',timestamp_ntz'1996-01-01 00:00:00'),(1L,1,null,null,null),(101L,1,'N','O',timestamp_ntz'1996-01-01 00:00:00'),"
        "(103L,2,'N','O',timestamp_ntz'1996-01-01 00:00:00'),(109L,3,'N','O',timestamp_ntz'1996-01-01 00:00:00') t(l_orderkey,l_linenumber,l_returnflag,l_linestatus,l_shipdate)"
    ).write.parquet(f"{base}/lineitem.parquet")
    spark.sql(
        "select id as o_orderkey, if(id = 1, 3L, 11L) as o_custkey, if(id = 1, null, timestamp_ntz'1996-01-01 00:00:00') as o_orderdate"
        " from values (1L),(101L),(103L),(109L) t(id)"
    ).write.parquet(f"{base}/orders.parquet")
    spark.sql("select * from values (3L, cast(null as int)),(11L, 7) t(c_custkey,c_nationkey)").write.parquet(f"{base}/customer.parquet")
    got = {r.value for r in tb.booking_lines(spark, base).collect()}
    people = '[{"uci":"C3","passengerType":"ADT","age":3,"tattoo":1},{"uci":"C3-2","passengerType":"chd","age":3,"tattoo":2}]'

    def event(out):
        flights = f'[{{"bookingStatus":"{out}","flight":{{"originAirport":"EIN","operatingAirline":"KL"}}}},'
        flights += '{"bookingStatus":"CONFIRMED","flight":{"destinationAirport":"EIN","operatingAirline":"KL"}}]'
        return f'"event":{{"DataElement":{{"travelrecord":{{"passengersList":{people},"productsList":{flights}}}}}}}}}'

    assert got == {
        '{"timestamp":"1996-01-01T00:00:01Z",' + event("CANCELLED"), "{" + event("CONFIRMED"), '{"timestamp":"1996-01-01T00:00:01Z","event":{',
        '{"timestamp":"1996-01-01T00:00:02Z","event":{}}', "",
    }
    plan = tb.booking_lines(spark, base)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(C, cast(c_custkey") <= 2  # the line is made once, and then cut


def test_quarantine_runs_read_the_feed_once(spark, monkeypatch):
    from paxflow.plans import catalog

    read = spark.sparkContext.accumulator(0)

    def lines(spark_, sf):
        def seen(value):
            read.add(1)
            return value

        return feed(spark).coalesce(1).select(F.udf(seen, "string").asNondeterministic()("value").alias("value"))

    monkeypatch.setattr(catalog, "lines", lines)
    got = {r.reason: r.rejects for r in catalog.quarantine_roundtrip(spark, "").collect()}
    assert got == {"malformed_json": 1, "missing_travelrecord": 1}
    assert read.value == len(LINES) + 1


def test_packed_lines_are_written_and_read(spark, scratch):
    from paxflow.sources.bookings import read_booking_events
    from paxflow.sources.ingest import booking_files
    from paxflow.sources.sinks import write_lines

    path = write_lines(feed(spark).coalesce(1), scratch("packed"), compression="gzip")
    assert all(r.file.endswith(".json.gz") for r in booking_files(spark, path, "*.json*").collect())
    assert bag(feed_legs(read_booking_events(spark, path, "*.json*"))) == bag(feed_legs(feed(spark)))


@pytest.mark.parametrize(("name", "most"), [("stream_retract_counts", 16), ("stream_evicted_state", 12 + 5)])
def test_a_larger_feed_is_replayed_in_no_more_files(spark, monkeypatch, name, most):
    from paxflow.plans import catalog
    from paxflow.sources import sinks
    from paxflow.streaming.publish import Folder

    folders = set()
    write = sinks.write_lines

    def written(df, path, *rest, **more):
        folders.add(path)
        return write(df, path, *rest, **more)

    def replayed(*_, **__):
        raise InterruptedError

    many = [line(f'[{P.replace("A", f"A{i}")}]', f"[{product()}]") for i in range(80)]
    monkeypatch.setattr(catalog, "lines", lambda *_: spark.createDataFrame([(v,) for v in many], "value STRING").repartition(40))
    monkeypatch.setattr(sinks, "write_lines", written)
    monkeypatch.setattr(catalog, "_replayed_ledger", replayed)
    with pytest.raises(InterruptedError):
        catalog.QUERIES[name](spark, "")
    (folder,) = folders
    assert 8 < sum(".json" in n for n in Folder(spark, folder).names()) <= most


def test_a_replayed_feed_is_packed_and_its_lines_are_dealt_out(spark, monkeypatch, scratch):
    from paxflow.plans import catalog
    from paxflow.streaming import stream as st
    from paxflow.streaming.publish import Folder

    monkeypatch.setattr(catalog, "lines", lambda *_: feed(spark).coalesce(1))
    path = catalog._replay_files(spark, "", "packed-feed")
    assert [n for n in Folder(spark, f"{path}/in").names() if n.startswith("part-")][0].endswith(".json.lz4")
    parsed = st.stream_legs(catalog._replayed_lines(spark, path))
    out = scratch("dealt")
    tasks = spark.sparkContext.accumulator(0)

    def take(batch, _):
        tasks.add(batch.select(F.spark_partition_id()).distinct().count())
        batch.write.mode("append").parquet(out)

    parsed.writeStream.option("checkpointLocation", scratch("dealt-at")).trigger(availableNow=True).foreachBatch(take).start().awaitTermination()
    assert bag(spark.read.parquet(out)) == bag(feed_legs(feed(spark)))
    plan = parsed._jdf.queryExecution().analyzed().toString()
    assert "RepartitionByExpression" in plan and tasks.value > 0


def test_legs_parse_no_member_that_they_do_not_have(spark):
    odd = [line(f'[{P.replace(":1}", f":{t}}}")}]', f"[{product()}]") for t in ('"1"', "1.5", "[1,{}]", '{"a":null}', "null", '"x"')]
    lines = spark.createDataFrame([(v,) for v in odd], "value STRING")
    assert bag(feed_legs(lines)) == bag(explode_legs(parse_events(lines)).select(*LEG_COLUMNS))
    plans = [feed_legs(lines, strict)._jdf.queryExecution().analyzed().toString() for strict in (False, True)]
    assert ["tattoo" in p for p in plans] == [False, True]


@pytest.mark.parametrize("name", ["stream_evicted_state", "stream_late_and_outlier"])
def test_a_feed_taken_file_by_file_is_packed(spark, monkeypatch, name):
    from paxflow.plans import catalog
    from paxflow.sources import airports as ap
    from paxflow.sources import sinks
    from paxflow.streaming.publish import Folder

    folders = []
    write = sinks.write_lines

    def written(df, path, *rest, **more):
        folders.append(path)
        return write(df, path, *rest, **more)

    booked = [line(f'[{P.replace("A", f"A{i}")}]', f"[{product()}]") for i in range(40)]
    feed_lines = [*booked, booked[7].replace(" confirmed", "cancelled").replace("2020-01-01", "2020-01-02", 1), "{cut", "", None]
    table = spark.createDataFrame([(v,) for v in tb.FIXED_AIRPORT_LINES], "value STRING")
    monkeypatch.setattr(catalog, "lines", lambda *_: spark.createDataFrame([(v,) for v in feed_lines], "value STRING").coalesce(2))
    monkeypatch.setattr(catalog, "airports", lambda *_: ap.clean_airports(ap.parse_airport_lines(table)))
    monkeypatch.setattr(sinks, "write_lines", written)
    got = sorted((str(r[0]), r[1], r[2]) for r in catalog.QUERIES[name](spark, "").collect())
    assert got == [("2020-01-02", "Netherlands", 39), ("2999-01-01", "Netherlands", 1)]
    (folder,) = set(folders)
    assert len(folders) == (3 if name == "stream_evicted_state" else 2)
    parts = [n for n in Folder(spark, folder).names() if n.startswith("part-")]
    assert parts and all(n.endswith(".json.lz4") for n in parts)
    outside = {"stream_evicted_state": 3, "stream_late_and_outlier": 1}[name]
    assert spark.read.text(folder).filter("value != ''").count() == len(booked) + 2 + outside  # the whole feed is in them


def test_a_scanned_feed_lies_on_disk_as_text_in_shares(spark, monkeypatch):
    from paxflow.plans import catalog
    from paxflow.sources import bookings, sinks
    from paxflow.streaming.publish import Folder

    booked = [line(f'[{P.replace("A", f"A{i}")}]', f"[{product()}]") for i in range(60)]
    feed_lines = [*booked, booked[0], *LINES, None]
    folders, written, scanned = set(), [], []
    write, read = sinks.write_lines, bookings.read_booking_events

    def counted(df, path, *rest, **more):
        written.append(df.count())
        folders.add(path)
        return write(df, path, *rest, **more)

    def default_scan(spark_, path):
        names = [n for n in Folder(spark, path).names() if n.startswith("part-")]
        scanned.append({n.rsplit(".", 1)[1] for n in names})
        assert spark.read.text(path).filter("value like '%DECOY%'").count() == 1
        return read(spark_, path)

    monkeypatch.setattr(catalog, "lines", lambda *_: spark.createDataFrame([(v,) for v in feed_lines], "value STRING").repartition(2))
    monkeypatch.setattr(catalog, "LINES_PER_FILE", 2, raising=False)
    monkeypatch.setattr(sinks, "write_lines", counted)
    monkeypatch.setattr(bookings, "read_booking_events", default_scan)
    got = catalog.QUERIES["scan_roundtrip"](spark, "")
    assert bag(got) == bag(feed_legs(spark.createDataFrame([(v,) for v in feed_lines], "value STRING")))
    assert sum(written) == len(feed_lines) and max(written) <= len(feed_lines) / 3  # all of it, never at once
    assert scanned == [{"json", "txt"}] * len(written)
    (folder,) = folders
    assert not Folder(spark, folder).names()  # no text is left behind


def test_a_scanned_feed_may_be_empty(spark, monkeypatch):
    from paxflow.plans import catalog

    monkeypatch.setattr(catalog, "lines", lambda *_: spark.createDataFrame([], "value STRING"))
    got = catalog.QUERIES["scan_roundtrip"](spark, "")
    assert got.columns == list(LEG_COLUMNS) and got.count() == 0
