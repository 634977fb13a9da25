"""Queries over rule tables, registers, feeds and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewake.functions import text as tx
from tidewake.functions.geo import acute_difference
from tidewake.operators import rules
from tidewake.operators import trajectory as tr
from tidewake.plans.registry import query
from tidewake.sources import ais, assembly
from tidewake.sources.fixtures import POINTS_SQL, POLYGONS_SQL, VOYAGES_SQL, cell_sql, haversine_sql, points, polygons, table, voyages

BANDS = [(1, 1, 0.0, 60.0), (2, 2, 50.0, 120.0), (3, 3, 110.0, 300.0), (4, 4, 250.0, 10_000.0)]
_BANDS_SQL = "bands(seq, level, low, high) AS (VALUES (1, 1, 0.0e0, 60.0e0), (2, 2, 50.0e0, 120.0e0), (3, 3, 110.0e0, 300.0e0), (4, 4, 250.0e0, 10000.0e0))"
_LATEST_SQL = "latest AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY t DESC, event_id DESC) = 1)"
_FAILED = "coalesce(string_agg(x, ';' ORDER BY i) FILTER (WHERE x IS NOT NULL), '')"


def _bands(spark):
    return spark.createDataFrame(BANDS, "seq int, level int, low double, high double")


def _latest(spark, sf_dir):
    return tr.latest_position(points(spark, sf_dir), "lon", "lat", "cog", "sog", "draught")


@query(f"WITH {POINTS_SQL}, {_BANDS_SQL} SELECT event_id, arg_max(level, seq) AS level FROM points LEFT JOIN bands ON sog BETWEEN low AND high GROUP BY event_id")
def weather_level(spark, sf_dir):
    return rules.range_lookup(points(spark, sf_dir), ["event_id"], "sog", _bands(spark), "level")


_LEVELS = " ".join(f"WHEN v >= {low}e0 THEN {i}" for i, low in reversed(list(enumerate(tx.WIND_LEVELS))))


@query(f"WITH {POINTS_SQL}, w AS (SELECT event_id, round(sog / 4, 1) AS v FROM points) SELECT CASE {_LEVELS} END AS level, count(*) AS n FROM w GROUP BY 1")
def beaufort(spark, sf_dir):
    return points(spark, sf_dir).groupBy(tx.wind_level(F.col("sog") / 4).alias("level")).agg(F.count(F.lit(1)).alias("n"))


_REPORT_SQL = """r AS (SELECT event_id, k, CASE WHEN k % 7 = 0 THEN '海面平静' ELSE '沿海海域东北风' || (k % 5 + 3) || '-' || (k % 5 + 4) || '级，阵风' || (k % 5 + 6) || '级' ||
  CASE WHEN k % 3 = 0 THEN '，夜里增强到' || (k % 5 + 5) || '级' ELSE '' END END AS report FROM points)"""


def _reports(spark, sf_dir):
    n = lambda add: (F.col("k") % 5 + add).cast("string")
    later = F.when(F.col("k") % 3 == 0, F.concat(F.lit("，夜里增强到"), n(5), F.lit("级"))).otherwise("")
    report = F.concat(F.lit("沿海海域东北风"), n(3), F.lit("-"), n(4), F.lit("级，阵风"), n(6), F.lit("级"), later)
    return points(spark, sf_dir).select("event_id", "k", F.when(F.col("k") % 7 == 0, "海面平静").otherwise(report).alias("report"))


@query(f"""WITH {POINTS_SQL}, {_REPORT_SQL} SELECT event_id, CASE WHEN k % 7 = 0 THEN '3-4' ELSE (k % 5 + 3) || '-' || (k % 5 + 4) || CASE WHEN k % 3 = 0 THEN ',' || (k % 5 + 5) ELSE '' END END AS winds,
CAST(CASE WHEN k % 7 = 0 THEN 4 WHEN k % 3 = 0 THEN k % 5 + 5 ELSE k % 5 + 4 END AS INTEGER) AS strongest, CAST(CASE WHEN k % 7 <> 0 THEN k % 5 + 6 END AS INTEGER) AS gust FROM r""")
def wind_extract(spark, sf_dir):
    r = _reports(spark, sf_dir).withColumns({"w": tx.wind_tokens("report"), "g": tx.gust_tokens("report")})
    return r.select("event_id", F.array_join("w", ",").alias("winds"), tx.strongest("w").alias("strongest"), tx.strongest("g").alias("gust"))


@query("""WITH r AS (SELECT o_orderkey, '最大风力达到' || (o_orderkey % 9 + 3) || '级，最小能见度达到' || (o_orderkey % 20 * 100) || '米，' || year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日7时5分发布' AS s, o_orderdate FROM orders)
SELECT o_orderkey, CAST(o_orderkey % 9 + 3 AS INTEGER) AS wind, CAST(o_orderkey % 20 * 100 AS INTEGER) AS sight, strftime(o_orderdate, '%Y-%m-%d') || ' 07:05' AS published FROM r""")
def report_figures(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    part = lambda f: f("o_orderdate").cast("string")
    report = F.concat(F.lit("最大风力达到"), (F.col("o_orderkey") % 9 + 3).cast("string"), F.lit("级，最小能见度达到"), (F.col("o_orderkey") % 20 * 100).cast("string"), F.lit("米，"),
                      part(F.year), F.lit("年"), part(F.month), F.lit("月"), part(F.day), F.lit("日7时5分发布"))
    wind, sight = tx.worst_wind_and_sight("report")
    return o.withColumn("report", report).select("o_orderkey", wind.alias("wind"), sight.alias("sight"), tx.published("report").alias("published"))


@query(f"""WITH {VOYAGES_SQL}, f AS (SELECT voyage, unnest([1, 2, 3, 4]) AS i, unnest([CASE WHEN distance / 100 > 20 + end_port THEN 'wind over limit' END, CASE WHEN ship % 40 * 50 < 700 THEN 'visibility under limit' END,
CASE WHEN teu * 12 > 20000 + end_port * 1500 THEN 'tonnage over limit' END, CASE WHEN ship % 11 > 6 THEN 'draught over depth' END]) AS x FROM voyages)
SELECT voyage, CAST(CASE WHEN count(x) = 0 THEN 1 ELSE 2 END AS INTEGER) AS status, {_FAILED} AS reasons FROM f GROUP BY voyage""")
def berth_rules(spark, sf_dir):
    v = voyages(spark, sf_dir).select(
        "voyage", (F.col("distance") / 100).alias("wind"), (F.lit(20.0) + F.col("end_port")).alias("max_wind"), (F.col("ship") % 40 * 50).alias("sight"), F.lit(700).alias("min_sight"),
        (F.col("teu") * 12).alias("dwt"), (F.lit(20_000) + F.col("end_port") * 1500).alias("max_dwt"), F.when(F.col("ship") % 11 > 1, F.col("ship") % 11).alias("draught"), F.lit(6).alias("depth"),
    )
    return rules.berth_admission(v).select("voyage", "status", "reasons")


@query(f"""WITH {POINTS_SQL}, {POLYGONS_SQL}, {_LATEST_SQL}, n AS (
  SELECT l.mmsi, g.polygon, l.cog, CAST(substr(g.polygon, 2) AS INTEGER) * 10 AS hole_cog, coalesce(c_custkey * 3 % 300, 0) AS length
  FROM latest l JOIN polygons g ON l.lon > g.west AND l.lon <= g.east AND l.lat >= g.south AND l.lat < g.north LEFT JOIN customer ON c_custkey * 3 = mmsi
), d AS (SELECT *, abs(cog - hole_cog) AS gap, CASE WHEN abs(cog - hole_cog) % 360 > 180 THEN 360 - abs(cog - hole_cog) % 360 ELSE abs(cog - hole_cog) % 360 END AS half FROM n),
f AS (SELECT mmsi, polygon, length, unnest([1, 2, 3]) AS i, unnest([CASE WHEN polygon = 'P20' THEN 'hole closed' END, CASE WHEN length > 200 THEN 'length over limit' END,
  CASE WHEN CASE WHEN half > 90 THEN 180 - half ELSE half END > 45 THEN 'course across the hole' END]) AS x FROM d WHERE gap <= 90 OR gap >= 270)
SELECT mmsi, polygon, length, CAST(CASE WHEN count(x) = 0 THEN 1 ELSE 2 END AS INTEGER) AS status, {_FAILED} AS reasons FROM f GROUP BY mmsi, polygon, length""")
def bridge_rules(spark, sf_dir):
    holes = polygons(spark).withColumns({"hole_cog": F.substring("polygon", 2, 2).cast("int") * 10, "max_length": F.lit(200), "closed": F.col("polygon") == "P20"})
    ships = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("mmsi"), (F.col("c_custkey") * 3 % 300).alias("length"), F.col("c_name").alias("ship_name"))
    weather = spark.createDataFrame([(8.0, 12.0)], "wind double, max_wind double")
    out = rules.bridge_passage(_latest(spark, sf_dir), holes, ships, weather)
    return out.select("mmsi", "polygon", "length", "status", "reasons")


@query(f"""WITH {POINTS_SQL}, {_LATEST_SQL} SELECT mmsi, coalesce(c_name, 'none') AS ship_name, coalesce(c_nationkey, -1) AS flag FROM latest LEFT JOIN customer ON c_custkey * 3 = mmsi""")
def static_lookup(spark, sf_dir):
    ships = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 3).alias("mmsi"), F.col("c_name").alias("ship_name"), F.col("c_nationkey").alias("flag"))
    return rules.lookup_or(_latest(spark, sf_dir), ships, "mmsi", {"ship_name": "none", "flag": -1}).select("mmsi", "ship_name", "flag")


@query("""SELECT coalesce(a.nation, b.nation) AS nation, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM
(SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey + 7 AS nation, count(*) AS suppliers FROM supplier GROUP BY 1) b ON a.nation = b.nation""")
def register_outer(spark, sf_dir):
    a = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    b = table(spark, sf_dir, "supplier").groupBy((F.col("s_nationkey") + 7).alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    return rules.merged_registers(a, b, "nation")


def _fleet(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("mmsi"))


@query(f"WITH {POINTS_SQL} SELECT mmsi, count(*) AS n FROM points WHERE mmsi IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') GROUP BY mmsi")
def ship_semi(spark, sf_dir):
    return points(spark, sf_dir).join(_fleet(spark, sf_dir), "mmsi", "left_semi").groupBy("mmsi").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {POINTS_SQL} SELECT mmsi, count(*) AS n FROM points WHERE mmsi NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') GROUP BY mmsi")
def ship_anti(spark, sf_dir):
    return points(spark, sf_dir).join(_fleet(spark, sf_dir), "mmsi", "left_anti").groupBy("mmsi").agg(F.count(F.lit(1)).alias("n"))


def _names(spark, sf_dir, condition):
    return table(spark, sf_dir, "part").filter(condition).select(tx.normal_name("p_name").alias("name"))


@query("SELECT lower(replace(p_name, ' ', '')) AS name FROM part WHERE p_size <= 25 INTERSECT SELECT lower(replace(p_name, ' ', '')) FROM part WHERE p_size > 25")
def name_intersect(spark, sf_dir):
    return _names(spark, sf_dir, "p_size <= 25").intersect(_names(spark, sf_dir, "p_size > 25"))


@query("SELECT lower(replace(p_name, ' ', '')) || p_size AS name FROM part WHERE p_partkey % 2 = 0 EXCEPT SELECT lower(replace(p_name, ' ', '')) || p_size FROM part WHERE p_partkey % 2 = 1")
def name_except(spark, sf_dir):
    sized = lambda parity: table(spark, sf_dir, "part").filter(f"p_partkey % 2 = {parity}").select(F.concat(tx.normal_name("p_name"), F.col("p_size").cast("string")).alias("name"))
    return sized(0).subtract(sized(1))


@query("""SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS port, CAST(-1 AS BIGINT) AS terminal FROM nation UNION ALL SELECT r_name, CAST(-1 AS BIGINT), CAST(r_regionkey AS BIGINT) FROM region""")
def union_ports(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("port"))
    b = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("long").alias("terminal"))
    return a.unionByName(b, allowMissingColumns=True).fillna(-1, subset=["port", "terminal"])


@query(f"WITH {POINTS_SQL} SELECT event_id, mmsi, t FROM points ORDER BY t DESC, event_id DESC LIMIT 1")
def newest_row(spark, sf_dir):
    return points(spark, sf_dir).select("event_id", "mmsi", "t").orderBy(F.desc("t"), F.desc("event_id")).limit(1)


@query(f"WITH {POINTS_SQL} SELECT max(event_id) AS event_id FROM (SELECT * FROM points ORDER BY t DESC, event_id DESC LIMIT 50) WHERE event_type = 'click'")
def newest_of_source(spark, sf_dir):
    return points(spark, sf_dir).orderBy(F.desc("t"), F.desc("event_id")).limit(50).filter("event_type = 'click'").agg(F.max("event_id").alias("event_id"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def max_date_filter(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.join(F.broadcast(o.agg(F.max("o_orderdate").alias("newest"))), F.col("o_orderdate") == F.col("newest"), "left_semi").select("o_orderkey")


@query(f"WITH {POINTS_SQL} SELECT event_type, slot, count(*) AS n, string_agg(CAST(mmsi AS VARCHAR), ',' ORDER BY mmsi) AS ships FROM (SELECT DISTINCT event_type, t // 86400 % 3 AS slot, mmsi FROM points) GROUP BY event_type, slot")
def ship_lists(spark, sf_dir):
    ships = F.array_join(F.transform(F.sort_array(F.collect_set("mmsi")), lambda x: x.cast("string")), ",")
    return points(spark, sf_dir).groupBy("event_type", F.expr("t div 86400 % 3").alias("slot")).agg(F.countDistinct("mmsi").alias("n"), ships.alias("ships"))


def _payload(*parts):
    return tx.armoured(F.concat(*parts), 168)


def _static_digits(mmsi, imo, name, kind):
    """A static report up to the ship's type: fields of 30 bits with the two zero bits that follow them are eight digits."""
    thirty = lambda x: tx.digits_of((F.col(x) if isinstance(x, str) else x).cast("long") * 4, 32)
    return F.concat(F.lit("14"), thirty(mmsi), thirty(imo), F.lit("0" * 10), tx.text_digits(name, 20), tx.digits_of(kind, 8))


@query(f"""WITH {POINTS_SQL} SELECT event_id, CAST(1 AS INTEGER) AS msg_type, mmsi, CAST(status AS INTEGER) AS status, CAST(trunc(sog) % 1000 AS BIGINT) / 10 AS sog,
round((CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * trunc(lon * 600000) / 600000, 6) AS lon, round((CASE WHEN k % 3 = 0 THEN -1 ELSE 1 END) * trunc(lat * 600000) / 600000, 6) AS lat, CAST(cog AS DOUBLE) AS cog, CAST(head AS INTEGER) AS heading FROM points""")
def ais_decode(spark, sf_dir):
    scaled = lambda name, sign: sign * (F.col(name) * 600_000).cast("long")
    east, north = F.when(F.col("k") % 2 == 0, 1).otherwise(-1), F.when(F.col("k") % 3 == 0, -1).otherwise(1)
    sent = points(spark, sf_dir).select("event_id", _payload(
        tx.bits_of(F.lit(1), 6), tx.bits_of(F.lit(0), 2), tx.bits_of("mmsi", 30), tx.bits_of("status", 4), tx.bits_of(F.lit(0), 8), tx.bits_of(F.col("sog").cast("long") % 1000, 10), tx.bits_of(F.lit(1), 1),
        tx.bits_of(scaled("lon", east), 28), tx.bits_of(scaled("lat", north), 27), tx.bits_of(F.col("cog") * 10, 12), tx.bits_of("head", 9),
    ).alias("payload"))
    out = ais.decoded(sent.select("event_id", "payload"), carried=["event_id"])
    return out.select("event_id", "msg_type", "mmsi", "status", "sog", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "cog", "heading")


@query("SELECT c_custkey, rtrim(upper(substr(c_name, 1, 20))) AS name, CAST(c_custkey % 100 AS INTEGER) AS ship_type FROM customer")
def ais_armour_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    digits = _static_digits("c_custkey", F.lit(0), "c_name", F.col("c_custkey") % 100)
    sent = c.select("c_custkey", tx.armoured_digits(digits, 424).alias("payload"))
    return ais.decoded(sent, carried=["c_custkey"]).select("c_custkey", "name", "ship_type")


@query(f"""WITH {POINTS_SQL} SELECT event_id, mmsi, upper(event_type) AS name, CAST(k AS INTEGER) AS ship_type FROM points WHERE event_id % 11 > 0 AND event_id % 13 > 0""")
def ais_reassembly(spark, sf_dir):
    """A static report an event in two sentences; some lose a part, some repeat one, some swap them, and ten sequence numbers serve all."""
    e = F.col("event_id")
    digits = _static_digits("mmsi", "event_id", F.upper("event_type"), "k")
    sent = points(spark, sf_dir).select("event_id", tx.armoured_digits(digits, 424).alias("body"))
    # Places of the parts in time; a null place is a lost part.
    swapped = e % 3 == 0
    first, second = F.when(e % 13 > 0, F.when(swapped, 400).otherwise(0)), F.when(e % 11 > 0, F.when(swapped, 0).otherwise(400))
    places = F.array(F.struct(F.lit(1).alias("part"), first.alias("ms")), F.struct(F.lit(2).alias("part"), second.alias("ms")), F.struct(F.lit(1).alias("part"), F.when(e % 5 == 0, first + 100).alias("ms")), F.struct(F.lit(2).alias("part"), F.when(e % 7 == 0, second + 300).alias("ms")))
    parts = sent.select("event_id", "body", F.inline(places)).filter("ms is not null")
    body = F.when(F.col("part") == 1, F.substring("body", 1, 56)).otherwise(F.substring("body", 57, 100))
    line = F.concat_ws(",", F.lit("!AIVDM,2"), F.col("part").cast("string"), (e % 10).cast("string"), F.when(e % 4 < 2, "A").otherwise("B"), body, F.lit("0*00"))
    feed = parts.select((e * 10_000 + F.col("ms")).alias("at"), line.alias("value"))
    out = ais.decoded(assembly.assembled(feed, limit=2_000, width=86_400_000))
    return out.select(F.col("imo").alias("event_id"), "mmsi", "name", "ship_type")


@query(f"""WITH {POINTS_SQL} SELECT mmsi, t, 246 AS supplier, {cell_sql('round(lon, 6)', 'round(lat, 6)')} AS cell, round(sog + 1e-9, 3) AS speed FROM points WHERE k % 2 = 0
UNION ALL SELECT mmsi, t, 248, {cell_sql('(round(lon * 1e6, 0) / 1e6)', '(round(lat * 1e6, 0) / 1e6)')}, round(trunc(sog * 1000) * (0.001e0 * 0.514444e0 * 10) + 1e-9, 3) FROM points WHERE k % 2 = 1""")
def parse_supplier_rows(spark, sf_dir):
    p = points(spark, sf_dir)
    s = lambda name: F.col(name).cast("string")
    micro = lambda name: F.round(F.col(name) * 1e6).cast("long").cast("string")
    degrees = lambda name: F.round(name, 6).cast("string")
    tabbed = p.filter("k % 2 = 0").select(F.concat(F.lit("x\t"), s("mmsi"), F.lit(" "), s("t"), F.lit("\tx\t"), F.concat_ws("@", s("status"), F.lit("0"), s("sog"), F.lit("1"), degrees("lon"), degrees("lat"), s("cog"), s("head"), F.lit("70"))).alias("value"))
    comma = p.filter("k % 2 = 1").select(F.concat_ws(",", s("mmsi"), s("t"), F.lit("0"), F.lit("x"), F.lit("0"), s("status"), micro("lon"), micro("lat"), F.lit("0"), (F.col("sog") * 1000).cast("long").cast("string"), F.lit("0"), s("cog"), s("head"), F.lit(""), F.lit("0&1&&&&")).alias("value"))
    broken = spark.createDataFrame([("header value",), ("longitude,x",), ("a\tb",), ("",)], "value string")
    columns = ["mmsi", "t", "supplier", "cell", F.round(F.col("speed") + 1e-9, 3).alias("speed")]
    return ais.tabbed_supplier(tabbed.unionByName(broken)).select(*columns).unionByName(ais.comma_supplier(comma.unionByName(broken)).select(*columns))


@query(f"""WITH {POINTS_SQL}, {_LATEST_SQL}, k AS (SELECT *, {haversine_sql('lon', 'lat', '122.5e0', '30.5e0')} AS km,
  (degrees(atan2(sin(radians(122.5e0) - radians(lon)) * cos(radians(30.5e0)), cos(radians(lat)) * sin(radians(30.5e0)) - sin(radians(lat)) * cos(radians(30.5e0)) * cos(radians(122.5e0) - radians(lon)))) + 720) % 360 AS toward FROM latest),
g AS (SELECT *, CASE WHEN abs(toward - cog) > 180 THEN 360 - abs(toward - cog) ELSE abs(toward - cog) END AS turn, degrees(atan(tan(60 / CASE WHEN km > 0 THEN km END))) AS half FROM k)
SELECT mmsi, CAST(trunc((km - 60) / (sog / 10 + 10) * 3600) AS BIGINT) AS enter_s, CAST(trunc((km + 60) / (sog / 10 + 10) * 3600) AS BIGINT) AS leave_s FROM g WHERE turn <= half AND km > 60""")
def sector_forecast(spark, sf_dir):
    return _forecast(spark, sf_dir)


def _forecast(spark, sf_dir):
    return rules.sector_forecast(_latest(spark, sf_dir), 122.5, 30.5, 60.0, F.col("sog") / 10 + 10)


@query(f"""WITH {POINTS_SQL}, {_LATEST_SQL}, f AS (SELECT mmsi, 70 + mmsi % 3 AS ship_type, t % 3000 AS enter_s, t % 3000 + 1800 AS leave_s FROM latest),
s AS (SELECT *, unnest([1, 3, 5, 7, 9]) AS slot FROM f)
SELECT ship_type, CAST(slot AS BIGINT) AS slot, count(*) AS n, string_agg(CAST(mmsi AS VARCHAR), ',' ORDER BY mmsi) AS ships FROM s WHERE slot BETWEEN enter_s // 600 AND leave_s // 600 GROUP BY ship_type, slot""")
def slot_counts(spark, sf_dir):
    f = _latest(spark, sf_dir).select("mmsi", (F.lit(70) + F.col("mmsi") % 3).alias("ship_type"), (F.col("t") % 3000).alias("enter_s"), (F.col("t") % 3000 + 1800).alias("leave_s"))
    return rules.slot_counts(f)


@query(f"""WITH {POINTS_SQL}, {_LATEST_SQL}, channel AS (SELECT range AS channel_id, 121.0e0 + 0.1e0 * range AS c_lon, 30.0e0 + 0.03e0 * range AS c_lat, range * 45 % 360 AS c_cog FROM range(35)),
m AS (SELECT mmsi, channel_id, {haversine_sql('lon', 'lat', 'c_lon', 'c_lat')} AS km FROM latest CROSS JOIN channel WHERE least(abs(cog - c_cog), 360 - abs(cog - c_cog)) < 90)
SELECT mmsi, channel_id, round(km, 6) AS channel_km FROM m QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY km, channel_id) = 1""")
def channel_nearest(spark, sf_dir):
    channel = spark.range(35).select(F.col("id").alias("channel_id"), (F.lit(121.0) + F.lit(0.1) * F.col("id")).alias("c_lon"), (F.lit(30.0) + F.lit(0.03) * F.col("id")).alias("c_lat"), (F.col("id") * 45 % 360).alias("c_cog"))
    return rules.nearest_channel_point(_latest(spark, sf_dir), channel).withColumn("channel_km", F.round("channel_km", 6))


@query("""SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal <= 5000 THEN c_acctbal ELSE -999 END AS checked, CASE WHEN half > 90 THEN 180 - half ELSE half END AS acute FROM
(SELECT *, CASE WHEN d > 180 THEN 360 - d ELSE d END AS half FROM (SELECT *, abs(c_custkey % 360 - c_nationkey * 14) % 360 AS d FROM customer))""")
def validators(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", tx.within("c_acctbal", 0, 5000).alias("checked"), acute_difference(F.col("c_custkey") % 360, F.col("c_nationkey") * 14).alias("acute"))


@query("""SELECT p_partkey, CASE WHEN p_brand IN ('Brand#1', 'Brand#12') THEN 'Brand#' ELSE p_brand END AS brand, replace(replace(p_name, ',', ''), ' ', '') AS plain,
CASE WHEN regexp_matches(p_type, '^[0-9.]+$') THEN p_type ELSE '0' END AS number, (p_size % 9 + 1) * 10000.0e0 AS low, (p_size % 9 + 3) * 10000.0e0 AS high FROM part""")
def name_rules(spark, sf_dir):
    p = table(spark, sf_dir, "part").filter(F.lit(True))
    tonnes = tx.tonnage_range(F.concat((F.col("p_size") % 9 + 1).cast("string"), F.lit("-"), (F.col("p_size") % 9 + 3).cast("string"), F.lit("万")))
    brand = F.when(F.col("p_brand").isin("Brand#1", "Brand#12"), F.regexp_replace("p_brand", "[0-9]", "")).otherwise(F.col("p_brand"))
    return p.select("p_partkey", brand.alias("brand"), tx.without_separators("p_name").alias("plain"), tx.numeric_or_zero("p_type").alias("number"), tonnes["low"].alias("low"), tonnes["high"].alias("high"))


_TABBED_SQL = "tabbed AS (SELECT mmsi, t, round(lon - k % 3 * 20, 6) AS lon, round(lat, 6) AS lat, 60 + k % 30 AS ship_type FROM points)"


def _tabbed(spark, sf_dir):
    s = lambda name: F.col(name).cast("string")
    degrees = lambda x: F.round(x, 6).cast("string")
    moved, kind = F.col("lon") - F.col("k") % 3 * 20, (F.lit(60) + F.col("k") % 30).cast("string")
    fields = F.concat_ws("@", s("status"), F.lit("0"), s("sog"), F.lit("1"), degrees(moved), degrees(F.col("lat")), s("cog"), s("head"), kind)
    rows = points(spark, sf_dir).select(F.concat(F.lit("x\t"), s("mmsi"), F.lit(" "), s("t"), F.lit("\tx\t"), fields).alias("value"))
    return rows.unionByName(spark.createDataFrame([("header value",), ("a\tb",), ("",)], "value string"))


@query(f"WITH {POINTS_SQL}, {_TABBED_SQL} SELECT mmsi, t, lon, lat, CAST(ship_type AS INTEGER) AS ship_type FROM tabbed WHERE ship_type BETWEEN 70 AND 79")
def supplier_cargo(spark, sf_dir):
    return ais.cargo_rows(_tabbed(spark, sf_dir)).select("mmsi", "t", "lon", "lat", "ship_type")


@query(f"WITH {POINTS_SQL}, {_TABBED_SQL} SELECT mmsi, t, lon, lat FROM tabbed WHERE lon BETWEEN 70 AND 89")
def supplier_longitudes(spark, sf_dir):
    return ais.rows_between(_tabbed(spark, sf_dir)).select("mmsi", "t", "lon", "lat")


@query(f"WITH {POINTS_SQL}, {_TABBED_SQL} SELECT mmsi, t, lon, lat FROM tabbed WHERE ship_type = 70 AND lon BETWEEN 100 AND 123 AND lat BETWEEN 30 AND 31")
def supplier_box(spark, sf_dir):
    return ais.boxed_positions(_tabbed(spark, sf_dir), 100.0, 123.0, 30.0, 31.0, ship_type=70)


@query(f"WITH {POINTS_SQL} SELECT mmsi, t, round(lon, 6) AS lon, round(lat, 6) AS lat, CAST(status AS INTEGER) AS status, CAST(k % 5 AS INTEGER) AS zone, round(sog, 2) AS sog, CAST(cog AS DOUBLE) AS cog, CAST(head AS DOUBLE) AS head, 0.0e0 AS rot FROM points WHERE k % 10 > 0")
def position_text(spark, sf_dir):
    s = lambda x: (F.col(x) if isinstance(x, str) else x).cast("string")
    number = F.when(F.col("k") % 10 == 0, "broken").otherwise(s(F.round("lon", 6)))
    lines = points(spark, sf_dir).select(F.concat_ws(",", s("mmsi"), s("t"), number, s(F.round("lat", 6)), s("status"), s(F.col("k") % 5), s(F.round("sog", 2)), s("cog"), s("head"), F.lit("0")).alias("value"))
    return ais.position_text(lines)
