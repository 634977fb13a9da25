"""Queries of planned calls and passages, of warnings over several sources, and of the services made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewake.functions.geo import haversine_km
from tidewake.operators import channels
from tidewake.operators import planning as pl
from tidewake.operators import rules
from tidewake.operators import stops as st
from tidewake.operators import trajectory as tr
from tidewake.operators import voyages as vo
from tidewake.plans.registry import SQL, query
from tidewake.plans.report_plans import _LEGS
from tidewake.plans.rule_plans import _LATEST_SQL, bridge_rules
from tidewake.sources.fixtures import POINTS_SQL, POLYGONS_SQL, haversine_sql, points, polygons, table

TYPES = ("bulk", "tanker", "container")
CLASSES = [(1, "bulk", 0, 180, 30_000), (2, "bulk", 170, 260, 70_000), (3, "bulk", 250, 350, 100_000), (4, "tanker", 0, 200, 20_000), (5, "tanker", 190, 330, 90_000), (6, "container", 0, 220, 25_000), (7, "container", 200, 320, 60_000)]
LIMITS = [("bulk", 7, 1000, 9), ("tanker", 6, 1500, 7), ("container", 8, 800, 8)]
DAY_WEATHER = {"wind_am": 5, "wind_pm": 7, "sight_am": 1600, "sight_pm": 900, "water_am": 3, "water_pm": 6, "max_height": 45, "max_dwt": 120_000}

_TYPE_SQL = "['bulk', 'tanker', 'container']"
_PLANS_SQL = f"""plans AS (SELECT o_orderkey AS plan, {_TYPE_SQL}[o_orderkey % 3 + 1] AS type, 100 + o_custkey % 300 AS length, 20 + o_custkey % 30 AS height, o_custkey * 37 % 160000 AS dwt,
  printf('%02d/%02d%02d', day(o_orderdate), o_orderkey * 7 % 24, o_custkey % 60) AS io_time,
  'B' || (o_orderkey % 25) || CASE WHEN o_orderkey % 8 = 0 THEN '/' || (o_custkey % 30) WHEN o_orderkey % 4 = 0 THEN '/B' || (o_custkey % 30) ELSE '' END AS berths FROM orders)"""
_CLASSES_SQL = f"classes(seq, class_type, min_len, max_len, class_dwt) AS (VALUES {', '.join(map(str, CLASSES))})"
_LIMITS_SQL = f"limits(type, max_wind, min_sight, berth_wind) AS (VALUES {', '.join(map(str, LIMITS))})"
_BERTHS_SQL = f"""berth_list AS (SELECT 'B' || range AS berth, CASE WHEN range % 3 = 2 THEN 90000 ELSE 20000 END AS low, CASE range % 3 WHEN 0 THEN 100000 WHEN 1 THEN 50000 ELSE 90000 END AS high,
  {_TYPE_SQL}[range // 3 % 3 + 1] AS berth_type FROM range(25))"""
_TODAY = f"{_PLANS_SQL}, {_LIMITS_SQL}, p AS (SELECT *, CAST(split_part(io_time, '/', 2) AS INTEGER) < 1200 AS am FROM plans JOIN limits USING (type))"
_WIND = f"CASE WHEN CASE WHEN am THEN {DAY_WEATHER['wind_am']} ELSE {DAY_WEATHER['wind_pm']} END >= max_wind THEN 'wind over limit' END"
_SIGHT = f"CASE WHEN CASE WHEN am THEN {DAY_WEATHER['sight_am']} ELSE {DAY_WEATHER['sight_pm']} END <= min_sight THEN 'visibility under limit' END"
_HEIGHT = f"CASE WHEN CASE WHEN am THEN {DAY_WEATHER['water_am']} ELSE {DAY_WEATHER['water_pm']} END + height >= {DAY_WEATHER['max_height']} THEN 'air draught over limit' END"


def _checked(*checks: str) -> str:
    numbers = ", ".join(str(i) for i in range(len(checks)))
    return f"""WITH {_TODAY}, f AS (SELECT plan, unnest([{numbers}]) AS i, unnest([{', '.join(checks)}]) AS x FROM p)
SELECT plan, CAST(CASE WHEN count(x) = 0 THEN 1 ELSE 2 END AS INTEGER) AS status, coalesce(string_agg(x, ';' ORDER BY i) FILTER (WHERE x IS NOT NULL), '') AS reasons FROM f GROUP BY plan"""


def _one_of(of):
    return F.element_at(F.array(*[F.lit(t) for t in TYPES]), (of % 3 + 1).cast("int"))


def _plans(spark, sf_dir):
    o, text = table(spark, sf_dir, "orders"), lambda x: x.cast("string")
    other = text(F.col("o_custkey") % 30)
    second = F.when(F.col("o_orderkey") % 8 == 0, F.concat(F.lit("/"), other)).when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("/B"), other)).otherwise("")
    return o.select(
        F.col("o_orderkey").alias("plan"), _one_of(F.col("o_orderkey")).alias("type"), (F.lit(100) + F.col("o_custkey") % 300).alias("length"), (F.lit(20) + F.col("o_custkey") % 30).alias("height"),
        (F.col("o_custkey") * 37 % 160_000).alias("dwt"), F.format_string("%02d/%02d%02d", F.day("o_orderdate"), F.col("o_orderkey") * 7 % 24, F.col("o_custkey") % 60).alias("io_time"),
        F.concat(F.lit("B"), text(F.col("o_orderkey") % 25), second).alias("berths"),
    )


def _today(spark, sf_dir):
    limits = spark.createDataFrame(LIMITS, "type string, max_wind int, min_sight int, berth_wind int")
    return _plans(spark, sf_dir).join(limits, "type").withColumns({name: F.lit(value) for name, value in DAY_WEATHER.items()})


@query("""SELECT o_orderkey FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS control, CASE WHEN o_custkey % 5 > 0 THEN 'B' || (o_custkey % 25) END AS berth FROM orders)
WHERE (control = 0 OR o_orderdate >= TIMESTAMP '1997-01-01' OR control IS NULL) AND berth IS NOT NULL""")
def unjudged_calls(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({
        "control": F.when(F.col("o_orderkey") % 3 < 2, F.col("o_orderkey") % 3), "berth": F.when(F.col("o_custkey") % 5 > 0, F.concat(F.lit("B"), (F.col("o_custkey") % 25).cast("string"))),
    })
    return pl.unjudged(o, "control", "o_orderdate", F.lit("1997-01-01").cast("timestamp_ntz"), "berth").select("o_orderkey")


@query(f"""WITH {_PLANS_SQL}, {_CLASSES_SQL}, {_BERTHS_SQL},
c AS (SELECT plan, type, 'B' || ltrim(split_part(berths, '/', -1), 'B') AS berth, coalesce(arg_max(class_dwt, seq), {pl.DEFAULT_DWT}) AS dwt FROM plans LEFT JOIN classes ON type = class_type AND length BETWEEN min_len AND max_len GROUP BY ALL)
SELECT plan, CAST(dwt AS INTEGER) AS dwt, coalesce(dwt BETWEEN low AND high AND type = berth_type, false) AS suits,
CASE WHEN dwt BETWEEN low AND high AND type = berth_type THEN '' ELSE 'ship does not suit the berth' END AS reason FROM c LEFT JOIN berth_list USING (berth)""")
def plan_berths(spark, sf_dir):
    classes = spark.createDataFrame(CLASSES, "seq int, class_type string, min_len int, max_len int, class_dwt int")
    third = F.col("id") % 3
    tonnage = F.when(third == 0, "2.0-10万").when(third == 1, "20000-50000").otherwise("90000")
    berths = spark.range(25).select(F.concat(F.lit("B"), F.col("id").cast("string")).alias("berth"), tonnage.alias("tonnage"), _one_of(F.expr("id div 3")).alias("berth_type"))
    plans = pl.tonnage_class(_plans(spark, sf_dir).drop("dwt"), classes)
    return pl.plan_berths(plans, berths).join(plans.select("plan", "dwt"), "plan").select("plan", "dwt", "suits", "reason")


@query(_checked(_WIND, _SIGHT))
def plan_weather(spark, sf_dir):
    return pl.plan_weather(_today(spark, sf_dir)).select("plan", "status", "reasons")


@query(_checked(_HEIGHT))
def plan_air_draught(spark, sf_dir):
    return pl.air_draught(_today(spark, sf_dir)).select("plan", "status", "reasons")


@query(_checked(f"CASE WHEN {DAY_WEATHER['wind_am']} >= berth_wind THEN 'leave before noon' END", f"CASE WHEN {DAY_WEATHER['wind_pm']} >= berth_wind THEN 'leave after noon' END"))
def in_berth_wind(spark, sf_dir):
    return pl.in_berth_wind(_today(spark, sf_dir)).select("plan", "status", "reasons")


@query(_checked(f"CASE WHEN dwt >= {DAY_WEATHER['max_dwt']} THEN 'tonnage over limit' END", _WIND, _SIGHT, _HEIGHT))
def bridge_plan(spark, sf_dir):
    return pl.bridge_plan(_today(spark, sf_dir)).select("plan", "status", "reasons")


WIND_BANDS, GUST_BANDS, SIGHT_BANDS = [(6, 7), (8, 9), (10, 11), (12, 99)], [(8, 8), (9, 10), (11, 12), (13, 99)], [(501, 1000), (201, 500), (51, 200), (0, 50)]


def _band_sql(value: str, bands) -> str:
    return "CASE " + " ".join(f"WHEN {value} BETWEEN {low} AND {high} THEN {i}" for i, (low, high) in reversed(list(enumerate(bands, 1)))) + " ELSE 0 END"


@query(f"""WITH {POINTS_SQL}, r AS (SELECT t // 86400 AS day, ['bay', 'cape', 'delta'][mmsi % 3 + 1] AS source, t, event_id, k % 13 AS wind, k % 13 + k % 3 AS gust, k * 53 % 20 * 60 AS sight,
  CAST(event_id % 5 > 0 AS INTEGER) AS confirmed, k % 5 AS level, 'officer ' || (k % 7) AS "by" FROM points),
n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY day, source ORDER BY t DESC, event_id DESC) = 1),
s AS (SELECT day, max(greatest({_band_sql('wind', WIND_BANDS)}, {_band_sql('gust', GUST_BANDS)})) AS wind_level, max(CASE WHEN source = 'cape' THEN {_band_sql('sight', SIGHT_BANDS)} END) AS sight_level,
  max(wind) AS worst_wind, max(gust) AS worst_gust, min(sight) AS worst_sight, count(*) FILTER (WHERE confirmed = 1) = 3 AS sure, max(level) FILTER (WHERE source = 'cape') AS level, max("by") FILTER (WHERE source = 'cape') AS "by" FROM n GROUP BY day)
SELECT day, CAST(wind_level AS INTEGER) AS wind_level, CAST(coalesce(sight_level, 0) AS INTEGER) AS sight_level, worst_wind, worst_gust, worst_sight, CAST(sure AS INTEGER) AS confirmed,
CASE WHEN sure THEN level ELSE 0 END AS level, CASE WHEN sure THEN "by" ELSE '' END AS "by" FROM s""")
def warning_state(spark, sf_dir):
    k = F.col("k")
    reports = points(spark, sf_dir).select(
        F.expr("t div 86400").alias("day"), F.element_at(F.array(*map(F.lit, ("bay", "cape", "delta"))), (F.col("mmsi") % 3 + 1).cast("int")).alias("source"), "t", F.col("event_id").alias("report"),
        (k % 13).alias("wind"), (k % 13 + k % 3).alias("gust"), (k * 53 % 20 * 60).alias("sight"), (F.col("event_id") % 5 > 0).cast("int").alias("confirmed"), (k % 5).alias("level"),
        F.concat(F.lit("officer "), (k % 7).cast("string")).alias("by"),
    )
    return pl.warning_state(pl.newest_by_source(reports, "day"), ["day"], WIND_BANDS, GUST_BANDS, SIGHT_BANDS, 3, "cape")


@query(f"""WITH {POLYGONS_SQL} SELECT g.polygon, coalesce(n, 0) AS n_ships, CAST(CASE WHEN worst = 2 THEN 1 ELSE 2 END AS INTEGER) AS alarm
FROM polygons g LEFT JOIN (SELECT polygon, count(*) AS n, max(status) AS worst FROM ({SQL['bridge_rules']}) GROUP BY polygon) USING (polygon)""")
def bridge_hole_counts(spark, sf_dir):
    return pl.hole_counts(polygons(spark), bridge_rules(spark, sf_dir))


_CHANNELS_SQL = f"""model AS (SELECT site // 7 AS channel_id, site % 7 AS seq, min(lon) AS lon, min(lat) + 0.004e0 AS lat, 2400.0e0 * (site % 7) + 60 * (site // 7) AS run_s,
  {haversine_sql('min(lon)', 'min(lat)', '122.5e0', '30.5e0')} < 60 AS inside FROM points GROUP BY site),
ahead AS (SELECT *, lead(lon) OVER w AS lon_2, lead(lat) OVER w AS lat_2, lead(run_s) OVER w AS run_2, cos(radians(lat)) AS scale FROM model WINDOW w AS (PARTITION BY channel_id ORDER BY seq)),
piece AS (SELECT *, (degrees(atan2(sin(radians(lon_2) - radians(lon)) * cos(radians(lat_2)), cos(radians(lat)) * sin(radians(lat_2)) - sin(radians(lat)) * cos(radians(lat_2)) * cos(radians(lon_2) - radians(lon)))) + 720) % 360 AS course FROM ahead WHERE lon_2 IS NOT NULL),
foot AS (SELECT l.mmsi, l.lon, l.lat, p.channel_id, p.seq, p.lon AS x1, p.lat AS y1, lon_2, lat_2, run_s, run_2,
  least(greatest(((l.lon - p.lon) * scale * (lon_2 - p.lon) * scale + (l.lat - p.lat) * (lat_2 - p.lat)) / (pow((lon_2 - p.lon) * scale, 2) + pow(lat_2 - p.lat, 2)), 0), 1) AS f
  FROM latest l CROSS JOIN piece p WHERE least(abs(cog - course), 360 - abs(cog - course)) < 90),
near AS (SELECT mmsi, channel_id, seq, {haversine_sql('lon', 'lat', '(x1 + (lon_2 - x1) * f)', '(y1 + (lat_2 - y1) * f)')} AS km, round(run_s + (run_2 - run_s) * f, 3) AS now_s FROM foot),
placed AS (SELECT * FROM near WHERE km < 1.5e0 QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY km, channel_id, seq) = 1),
own AS (SELECT mmsi, channel_id, gate_in - now_s AS enter_s, gate_out - now_s AS leave_s FROM placed JOIN (SELECT channel_id, min(run_s) AS gate_in, max(run_s) AS gate_out FROM model WHERE inside GROUP BY channel_id) USING (channel_id) WHERE gate_in > now_s AND gate_out > now_s),
free AS ({SQL['sector_forecast']}),
forecast AS (SELECT * FROM own UNION ALL SELECT mmsi, NULL, enter_s, leave_s FROM free WHERE mmsi NOT IN (SELECT mmsi FROM own))"""


def _channel_forecast(spark, sf_dir):
    """Ships against five channels, one through each row of sites, whose vertices come from the points themselves."""
    at, p = F.col("site"), points(spark, sf_dir)
    inside = haversine_km("lon", "lat", F.lit(122.5), F.lit(30.5)) < 60
    seen = p.groupBy("site").agg(F.min("lon").alias("lon"), F.min("lat").alias("lat")).withColumn("inside", inside)
    model = seen.select(F.floor(at / 7).alias("channel_id"), (at % 7).alias("seq"), "lon", (F.col("lat") + 0.004).alias("lat"), (2400.0 * (at % 7) + 60 * F.floor(at / 7)).alias("run_s"), "inside")
    return channels.forecast(tr.latest_position(p, "lon", "lat", "cog", "sog"), model, 122.5, 30.5, 60.0, F.col("sog") / 10 + 10)


@query(f"WITH {POINTS_SQL}, {_LATEST_SQL}, {_CHANNELS_SQL} SELECT mmsi, channel_id, round(enter_s, 2) AS enter_s, round(leave_s, 2) AS leave_s FROM forecast")
def channel_forecast(spark, sf_dir):
    """When each ship enters and leaves the circle ahead: by its channel's own times, or by course and speed without one."""
    return _channel_forecast(spark, sf_dir).withColumns({"enter_s": F.round("enter_s", 2), "leave_s": F.round("leave_s", 2)})


@query(f"""WITH {POINTS_SQL}, {_LATEST_SQL}, {_CHANNELS_SQL}, s AS (SELECT 70 + mmsi % 3 AS ship_type, mmsi, unnest([1, 3, 5, 7, 9]) AS slot, floor(enter_s / 600) AS a, floor(leave_s / 600) AS b FROM forecast)
SELECT ship_type, CAST(slot AS BIGINT) AS slot, count(*) AS n, string_agg(CAST(mmsi AS VARCHAR), ',' ORDER BY mmsi) AS ships FROM s WHERE slot BETWEEN a AND b GROUP BY ship_type, slot""")
def traffic_forecast(spark, sf_dir):
    """How many ships of each type the circle holds in each slot of ten minutes, along channels and without."""
    ahead = _channel_forecast(spark, sf_dir).select("mmsi", (F.lit(70) + F.col("mmsi") % 3).alias("ship_type"), F.floor("enter_s").alias("enter_s"), F.floor("leave_s").alias("leave_s"))
    return rules.slot_counts(ahead, slot_s=channels.SLOT_S)


@query(f"""{_LEGS}, s AS (SELECT *, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS step FROM met WINDOW w AS (PARTITION BY mmsi, stop ORDER BY t, event_id)),
f AS (SELECT *, coalesce(step / greatest(t - lag(t) OVER w, 1) * 3600 / 1.852e0 > 0.5 AND sog > 5 AND lag(sog) OVER w > 5 AND (lag(sog) OVER w - sog) / greatest(t - lag(t) OVER w, 1) < 0.01e0, false) AS steady FROM s WINDOW w AS (PARTITION BY mmsi, stop ORDER BY t, event_id)),
k AS (SELECT mmsi, stop, CASE WHEN count(*) > 1 THEN round(avg(sog), 6) END AS steady_kn FROM (SELECT *, steady OR coalesce(lead(steady) OVER (PARTITION BY mmsi, stop ORDER BY t, event_id), false) AS marked FROM f) WHERE marked GROUP BY mmsi, stop),
d AS (SELECT mmsi, stop, count(*) AS n_points, coalesce(sum(step), 0) AS km, CASE WHEN count(DISTINCT draught) = 2 THEN last(draught ORDER BY t, event_id) END AS draught FROM s GROUP BY mmsi, stop)
SELECT l.mmsi, l.stop, l.start_site, l.end_site, l.start_t, l.end_t, l.sea_s, p.end_t - p.begin_t AS port_s, n_points, round(km, 6) AS distance_km, draught, round(km / (l.sea_s / 3600) + 1e-9, 4) AS speed_kmh, steady_kn
FROM legs l JOIN d USING (mmsi, stop) LEFT JOIN k USING (mmsi, stop) JOIN stops p ON p.mmsi = l.mmsi AND p.stop = l.stop""")
def voyage_rows(spark, sf_dir):
    p = points(spark, sf_dir)
    calls = st.summarised(st.stop_members(p), "site")
    out = vo.voyage_rows(p, calls, pair_kn=0.5)
    return out.withColumns({"distance_km": F.round("distance_km", 6), "speed_kmh": F.round(F.col("speed_kmh") + 1e-9, 4)})


@query("""SELECT c_custkey, CASE WHEN c_custkey % 100 BETWEEN 70 AND 79 THEN 'cargo' WHEN c_custkey % 100 BETWEEN 80 AND 89 THEN 'tanker' ELSE 'other' END AS ship_class,
contains(lower(c_name), 'customer#0000000') AS named FROM customer""")
def ship_classes(spark, sf_dir):
    kind = F.col("c_custkey") % 100
    named = F.contains(F.lower("c_name"), F.lit("customer#0000000"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(kind.between(70, 79), "cargo").when(kind.between(80, 89), "tanker").otherwise("other").alias("ship_class"), named.alias("named"))


@query(f"""WITH {POINTS_SQL}, b AS (SELECT site, t // 3600 AS hour, count(*) AS n FROM points GROUP BY 1, 2)
SELECT site, count(*) AS bins, round(avg(n) + 1e-9, 6) AS mean, round(stddev_samp(n) + 1e-9, 6) AS deviation, min(n) AS least, max(n) AS most FROM b GROUP BY site""")
def bin_statistics(spark, sf_dir):
    bins = points(spark, sf_dir).groupBy("site", F.expr("t div 3600").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    near = lambda x: F.round(x + 1e-9, 6)
    return bins.groupBy("site").agg(F.count(F.lit(1)).alias("bins"), near(F.avg("n")).alias("mean"), near(F.stddev_samp("n")).alias("deviation"), F.min("n").alias("least"), F.max("n").alias("most"))


@query(f"""WITH {POINTS_SQL}, s AS (SELECT mmsi, t // 86400 AS day, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS step FROM points WINDOW w AS (PARTITION BY mmsi ORDER BY t, event_id))
SELECT day, mmsi % 4 AS teu_band, count(DISTINCT mmsi) AS ships, round(coalesce(sum(step), 0), 4) AS km FROM s GROUP BY 1, 2""")
def daily_distance_by_band(spark, sf_dir):
    s = tr.stepped(points(spark, sf_dir))
    return s.groupBy(F.expr("t div 86400").alias("day"), (F.col("mmsi") % 4).alias("teu_band")).agg(F.countDistinct("mmsi").alias("ships"), F.round(F.coalesce(F.sum("step_km"), F.lit(0.0)), 4).alias("km"))
