"""Bridge from the driver's TPC-H-like tables to raw booking input.

``booking_lines`` turns every lineitem (joined to its order and customer)
into one raw booking event line, so the engine is exercised from text
exactly as it would be on a booking feed. ``airport_lines`` turns the
nation/region tables into airport CSV lines. Both are plain Spark plans
over the tables; their size grows with the tables.

Mapping (o = order, l = line, c = customer):

* event timestamp: ``l_shipdate + l_linenumber seconds`` (line 3 written
  with a +02:00 offset, line 4 without offset, else ``Z``)
* passengers: ``C<custkey>`` (CHD when custkey % 7 = 0, age custkey % 90,
  null when custkey % 11 = 0) plus, when custkey % 3 = 0, a child
  companion ``C<custkey>-2`` typed ``chd`` with age custkey % 12
* outbound product: origin by orderkey % 4, destination ``N<nationkey>``,
  departure ``o_orderdate + orderkey % 24 h``, arrival ``+1 + orderkey % 11 h``,
  airline AF when orderkey % 5 = 0 else KL, CANCELLED when returnflag R,
  ``Confirmed`` (mixed case) when linestatus F, else CONFIRMED
* return product: reverse route, departs ``24 * (2 + orderkey % 9) + orderkey % 7 h``
  after the outbound, airline DL when orderkey % 3 = 0 else KL,
  CANCELLED when returnflag A
* injected bad input: orderkey % 101 = 0 on line 1 is cut JSON, % 103 on
  line 2 has no travel record, % 109 on line 3 is blank, % 107 drops the
  main passenger's uci.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bridge.
ORIGIN_BY_ORDER = ("AMS", "EIN", "RTM", "JFK")
ZONE_BY_REGION = ("Africa/Cairo", "America/New_York", "Asia/Tokyo", "Europe/London", "Asia/Dubai")
FIXED_AIRPORT_LINES = (
    '1,"Amsterdam Airport Schiphol","Amsterdam","Netherlands","AMS","EHAM",52.308601,4.76389,-11,1,"E","Europe/Amsterdam","airport","OurAirports"',
    '2,"Eindhoven Airport","Eindhoven","Netherlands","EIN","EHEH",51.4500999451,5.37452983856,74,1,"E","Europe/Amsterdam","airport","OurAirports"',
    '3,"Rotterdam The Hague Airport","Rotterdam","Netherlands","RTM","EHRD",51.956902,4.43722,-15,1,"E","Europe/Amsterdam","airport","OurAirports"',
    '4,"John F Kennedy International Airport","New York","United States","JFK","KJFK",40.63980103,-73.77890015,13,-5,"A","America/New_York","airport","OurAirports"',
    '998,"No Code","Nowhere","Nowhere",,\\N,0,0,0,0,"U","UTC","airport","OurAirports"',
    '999,"Too short"',
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(ts: Column, suffix: str = "Z") -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit(suffix))


def _hours(n: Column, ts: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def _nation_code(nk: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nk.cast("string"), 2, "0"))


def _origin(k: Column) -> Column:
    m = k % 4
    return (
        F.when(m == 0, ORIGIN_BY_ORDER[0])
        .when(m == 1, ORIGIN_BY_ORDER[1])
        .when(m == 2, ORIGIN_BY_ORDER[2])
        .otherwise(ORIGIN_BY_ORDER[3])
    )


def booking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x order x customer, projected to the columns the event
    lines need. Joins are left to the planner (shuffle joins at scale).

    Orders meet their customers first, so lines are shuffled once, by order.
    The four times of an order are written as text there, once for all of its
    lines: ``dep``, ``arr``, ``rdep``, ``rarr``."""
    l = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    dep = _hours(k % 24, F.col("o_orderdate"))
    rdep = _hours(24 * (2 + k % 9) + k % 7, dep)
    times = {"dep": dep, "arr": _hours(1 + k % 11, dep), "rdep": rdep, "rarr": _hours(1 + k % 11, rdep)}
    o = o.select("o_orderkey", "o_custkey", *[_iso(ts).alias(name) for name, ts in times.items()])
    booked = o.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    return l.join(booked, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey")


def _text(name: str, value: Column) -> Column:
    """A JSON text member; null where the value is. No value of the bridge has a character that JSON escapes."""
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _number(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _object(*members: Column) -> Column:
    """A JSON object; null members are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def booking_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw booking JSON line (column ``value``) per lineitem."""
    rows = booking_rows(spark, sf_dir)
    k, ln, ck = F.col("o_orderkey"), F.col("l_linenumber"), F.col("c_custkey")
    ets = F.timestamp_add("SECOND", ln, F.col("l_shipdate"))
    written = F.when(ln == 3, _hours(F.lit(2), ets)).otherwise(ets)
    ets_text = F.concat(_iso(written, ""), F.when(ln == 3, "+02:00").when(ln == 4, "").otherwise("Z"))
    dest = _nation_code(F.col("c_nationkey"))
    origin = _origin(k)

    main = _object(
        F.when(k % 107 != 0, _text("uci", F.concat(F.lit("C"), ck.cast("string")))),
        _text("passengerType", F.when(ck % 7 == 0, "CHD").otherwise("ADT")),
        F.when(ck % 11 != 0, _number("age", (ck % 90).cast("int"))),
        _number("tattoo", F.lit(1)),
    )
    companion = _object(
        _text("uci", F.concat(F.lit("C"), ck.cast("string"), F.lit("-2"))),
        _text("passengerType", F.lit("chd")),
        _number("age", (ck % 12).cast("int")),
        _number("tattoo", F.lit(2)),
    )
    passengers = F.concat_ws(",", main, F.when(ck % 3 == 0, companion))

    def product(status, org, dst, d, a, airline):
        flight = _object(
            _text("originAirport", org),
            _text("destinationAirport", dst),
            _text("departureDate", F.col(d)),
            _text("arrivalDate", F.col(a)),
            _text("operatingAirline", airline),
        )
        return _object(_text("bookingStatus", status), F.concat(F.lit('"flight":'), flight))

    out_status = (
        F.when(F.col("l_returnflag") == "R", "CANCELLED")
        .when(F.col("l_linestatus") == "F", "Confirmed")
        .otherwise("CONFIRMED")
    )
    ret_status = F.when(F.col("l_returnflag") == "A", "CANCELLED").otherwise("CONFIRMED")
    products = F.concat_ws(
        ",",
        product(out_status, origin, dest, "dep", "arr", F.when(k % 5 == 0, "AF").otherwise("KL")),
        product(ret_status, dest, origin, "rdep", "rarr", F.when(k % 3 == 0, "DL").otherwise("KL")),
    )
    record = F.concat(F.lit('"event":{"DataElement":{"travelrecord":{"passengersList":['), passengers, F.lit('],"productsList":['), products, F.lit("]}}}"))
    # The line stands here once, and is cut afterwards: the JVM compiles no method as long as two of it.
    cut, bare, blank = (k % 101 == 0) & (ln == 1), (k % 103 == 0) & (ln == 2), (k % 109 == 0) & (ln == 3)
    event = F.when(bare, F.lit('"event":{}')).otherwise(record)
    line = F.when(bare & ets.isNull(), F.lit(None)).otherwise(_object(_text("timestamp", ets_text), event))
    length = F.when(cut, 45).when(blank, 0).otherwise(2**31 - 1)
    return rows.select(F.substr(line, F.lit(1), length).alias("value"))


def airport_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport CSV lines (column ``value``): one per nation, a few
    deliberate defects, and the fixed origin airports.

    nation 18: latitude 'n/a' and altitude \\N; 21: country \\N; 22: empty
    zone; 23: unknown zone; 24: zone \\N; 19 gets a later row (id 300,
    zone Pacific/Auckland) that replaces it; 20 gets an earlier row (id 50)
    that loses.
    """
    n = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    nk, rk = F.col("n_nationkey"), F.col("n_regionkey")
    zone = F.when(rk == 0, ZONE_BY_REGION[0])
    for i, z in enumerate(ZONE_BY_REGION[1:], start=1):
        zone = zone.when(rk == i, z)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def line(airport_id, name, country, zone_field, lat=None, alt=None):
        return F.concat_ws(
            ",",
            airport_id.cast("string"),
            q(name),
            q(F.concat(F.lit("City "), nk.cast("string"))),
            country,
            q(_nation_code(nk)),
            q(F.concat(F.lit("X"), _nation_code(nk))),
            lat if lat is not None else (nk * 1.5).cast("string"),
            (rk * 10.25).cast("string"),
            alt if alt is not None else (nk * 10).cast("string"),
            (rk - 2).cast("string"),
            q(F.lit("E")),
            zone_field,
            q(F.lit("airport")),
            q(F.lit("derived")),
        )

    name = F.concat(F.lit("Airport "), F.col("n_name"))
    base = line(
        100 + nk,
        name,
        F.when(nk == 21, F.lit("\\N")).otherwise(q(F.col("n_name"))),
        F.when(nk == 22, F.lit("")).when(nk == 23, q(F.lit("Invalid/Zone"))).when(nk == 24, F.lit("\\N")).otherwise(q(zone)),
        lat=F.when(nk == 18, q(F.lit("n/a"))).otherwise((nk * 1.5).cast("string")),
        alt=F.when(nk == 18, F.lit("\\N")).otherwise((nk * 10).cast("string")),
    )
    newer = line(F.lit(300), F.concat(name, F.lit(" New")), q(F.col("n_name")), q(F.lit("Pacific/Auckland")))
    older = line(F.lit(50), F.concat(name, F.lit(" Old")), q(F.lit("Shadow Country")), q(F.lit("Asia/Tokyo")))
    derived = (
        n.select(base.alias("value"))
        .unionByName(n.filter(nk == 19).select(newer.alias("value")))
        .unionByName(n.filter(nk == 20).select(older.alias("value")))
    )
    fixed = spark.createDataFrame([(v,) for v in FIXED_AIRPORT_LINES], "value STRING")
    return derived.unionByName(fixed)
