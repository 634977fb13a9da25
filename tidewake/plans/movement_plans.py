"""Queries over the ordered positions of ships."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewake.functions.geo import cell_id, haversine_km, near_cells
from tidewake.operators import spatial
from tidewake.operators import trajectory as tr
from tidewake.plans.registry import query
from tidewake.sources.fixtures import POINTS_SQL, POLYGONS_SQL, cell_sql, haversine_sql, points, polygons, site_gate

CENTRE = (122.5, 30.5)
_STEPS = f"""{POINTS_SQL}, stepped AS (
  SELECT *, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS step_km, greatest(t - lag(t) OVER w, 1) AS step_s, lag(sog) OVER w AS sog_before
  FROM points WINDOW w AS (PARTITION BY mmsi ORDER BY t, event_id))"""
_INSIDE = f"""{POINTS_SQL}, flagged AS (SELECT *, {haversine_sql('lon', 'lat', '122.5e0', '30.5e0')} < 60 AS inside FROM points)"""
_ORDER = "(PARTITION BY mmsi ORDER BY t, event_id)"


def _flagged(spark, sf_dir):
    return points(spark, sf_dir).withColumn("inside", haversine_km("lon", "lat", F.lit(CENTRE[0]), F.lit(CENTRE[1])) < 60)


@query(f"WITH {_STEPS} SELECT mmsi, count(*) AS n_points, round(coalesce(sum(step_km), 0), 6) AS distance_km FROM stepped GROUP BY mmsi")
def trip_distance(spark, sf_dir):
    return tr.trip_distance(points(spark, sf_dir))


@query(f"WITH {_STEPS} SELECT mmsi, round(avg(step_km / step_s * 3600), 6) AS mean_kmh, round(max(step_km / step_s * 3600), 6) AS max_kmh FROM stepped GROUP BY mmsi")
def pair_speed(spark, sf_dir):
    return tr.pair_speed(points(spark, sf_dir))


@query(f"""WITH {_STEPS}, s AS (
  SELECT *, coalesce(step_km / step_s * 3600 / 1.852e0 > 0.5 AND sog > 5 AND sog_before > 5 AND (sog_before - sog) / step_s < 0.01e0, false) AS steady FROM stepped
), m AS (SELECT *, steady OR coalesce(lead(steady) OVER {_ORDER}, false) AS marked FROM s)
SELECT mmsi, count(*) FILTER (WHERE marked) AS n_marked, CASE WHEN count(*) FILTER (WHERE marked) > 1 THEN round(avg(sog) FILTER (WHERE marked), 6) END AS steady_kn FROM m GROUP BY mmsi""")
def steady_speed(spark, sf_dir):
    return tr.steady_speed(points(spark, sf_dir), pair_kn=0.5)


@query(f"WITH {POINTS_SQL} SELECT {cell_sql('lon', 'lat')} AS cell, count(*) AS n_points, count(DISTINCT mmsi) AS n_ships FROM points GROUP BY 1")
def cell_density(spark, sf_dir):
    return points(spark, sf_dir).groupBy(cell_id("lon", "lat").alias("cell")).agg(F.count(F.lit(1)).alias("n_points"), F.countDistinct("mmsi").alias("n_ships"))


@query(f"""WITH {POINTS_SQL}, ports AS (SELECT site AS port, min(lon) AS port_lon, min(lat) AS port_lat FROM points GROUP BY site), moves AS (SELECT unnest(range(-11, 12)) AS i), lats AS (SELECT unnest(range(-3, 4)) AS j),
reach AS (SELECT *, CAST(floor(25 / (111.319e0 * 0.1e0 * cos(radians(abs(port_lat) + 3 * 0.1e0)))) + 1 AS INTEGER) AS steps FROM ports)
SELECT DISTINCT port, {cell_sql('(port_lon + i * 0.1e0)', '(port_lat + j * 0.1e0)')} AS cell FROM reach, moves, lats WHERE abs(i) <= steps""")
def near_cells_of_ports(spark, sf_dir):
    sites = points(spark, sf_dir).groupBy(F.col("site").alias("port")).agg(F.min("lon").alias("port_lon"), F.min("lat").alias("port_lat"))
    return sites.select("port", F.explode(near_cells("port_lon", "port_lat", 25.0)).alias("cell"))


@query(f"WITH {_INSIDE} SELECT mmsi, count(*) AS n_inside, min(t) AS t_first FROM flagged WHERE inside GROUP BY mmsi")
def geofence_circle(spark, sf_dir):
    return _flagged(spark, sf_dir).filter("inside").groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_inside"), F.min("t").alias("t_first"))


@query(f"""WITH {POINTS_SQL}, cut AS (SELECT *, CASE WHEN abs(lon - lag(lon) OVER {_ORDER}) > 2 THEN 1 ELSE 0 END AS cut FROM points),
lines AS (SELECT *, sum(cut) OVER {_ORDER} AS line FROM cut)
SELECT mmsi, CAST(line AS BIGINT) AS line, count(*) AS n_points, min(t) AS t_first FROM lines GROUP BY mmsi, line""")
def antimeridian_split(spark, sf_dir):
    return tr.antimeridian_split(points(spark, sf_dir), jump=2.0).groupBy("mmsi", "line").agg(F.count(F.lit(1)).alias("n_points"), F.min("t").alias("t_first"))


@query(f"WITH {POINTS_SQL} SELECT mmsi, t, event_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM points QUALIFY row_number() OVER (PARTITION BY mmsi ORDER BY t DESC, event_id DESC) = 1")
def latest_position(spark, sf_dir):
    return tr.latest_position(points(spark, sf_dir), "lon", "lat").select("mmsi", "t", "event_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query(f"""WITH {POINTS_SQL}, s AS (SELECT mmsi, event_id, t - first(t) OVER {_ORDER} AS since FROM points)
SELECT mmsi, event_id, since % 604800 AS shift, since // 604800 AS lap FROM s""")
def time_axis_shift(spark, sf_dir):
    return tr.time_axis_shift(points(spark, sf_dir), 604_800).select("mmsi", "event_id", "shift", "lap")


@query(f"""WITH {POINTS_SQL}, n AS (SELECT *, lead(lon) OVER {_ORDER} - lon AS dx, lead(lat) OVER {_ORDER} - lat AS dy FROM points)
SELECT mmsi, event_id, round(coalesce(CASE WHEN dx > 0 THEN 90 + degrees(atan(dy / dx)) WHEN dx < 0 THEN 270 + degrees(atan(dy / dx)) END, 0), 6) AS bearing FROM n""")
def fit_bearing(spark, sf_dir):
    return tr.fit_bearing(points(spark, sf_dir)).select("mmsi", "event_id", "bearing")


@query(f"""WITH {_STEPS}, f AS (SELECT *, step_km * 1e6 / step_s > 300 AS fast FROM stepped),
c AS (SELECT *, CASE WHEN fast <> lag(fast) OVER {_ORDER} THEN 1 ELSE 0 END AS change FROM f), s AS (SELECT *, sum(change) OVER {_ORDER} AS segment FROM c)
SELECT mmsi, CAST(segment AS BIGINT) AS segment, count(*) AS n_points, min(t) AS t_first FROM s GROUP BY mmsi, segment""")
def speed_cut(spark, sf_dir):
    return tr.speed_cut(points(spark, sf_dir)).groupBy("mmsi", "segment").agg(F.count(F.lit(1)).alias("n_points"), F.min("t").alias("t_first"))


@query(f"""WITH {_INSIDE}, r AS (SELECT *, sum(CASE WHEN inside THEN 0 ELSE 1 END) OVER {_ORDER} AS run FROM flagged)
SELECT mmsi, CAST(run AS BIGINT) AS run, count(*) AS n_points, max(t) - min(t) AS seconds FROM r WHERE inside GROUP BY mmsi, run""")
def inside_runs(spark, sf_dir):
    runs = tr.inside_runs(_flagged(spark, sf_dir)).filter("inside")
    return runs.groupBy("mmsi", "run").agg(F.count(F.lit(1)).alias("n_points"), (F.max("t") - F.min("t")).alias("seconds"))


_HITS = f"""{POINTS_SQL}, {POLYGONS_SQL}, hits AS (
  SELECT p.*, g.polygon FROM points p JOIN polygons g ON p.lon > g.west AND p.lon <= g.east AND p.lat >= g.south AND p.lat < g.north)"""


@query(f"""WITH {_HITS}, named AS (SELECT p.*, h.polygon FROM points p LEFT JOIN hits h ON p.event_id = h.event_id)
SELECT mmsi, event_id, last_value(polygon IGNORE NULLS) OVER (PARTITION BY mmsi ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM named""")
def carry_forward_gate(spark, sf_dir):
    p = points(spark, sf_dir)
    gates = spatial.first_polygon(p, polygons(spark), ["event_id"])
    return tr.carry_forward(p.join(gates, "event_id", "left"), "polygon").select("mmsi", "event_id", "carried")


@query(f"""WITH {_INSIDE}, l AS (SELECT *, CASE WHEN lag(inside) OVER {_ORDER} AND NOT inside THEN 1 ELSE 0 END AS leaves FROM flagged),
e AS (SELECT *, sum(leaves) OVER {_ORDER} AS exits FROM l)
SELECT mmsi, count(*) AS n_points, max(t) AS t_last FROM e WHERE exits = 0 GROUP BY mmsi""")
def prefix_until_exit(spark, sf_dir):
    return tr.prefix_until_exit(_flagged(spark, sf_dir)).groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_points"), F.max("t").alias("t_last"))


def _area(a, b, p) -> str:
    return f"(({b[0]} - {a[0]}) * ({p[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({p[0]} - {a[0]}))"


_A, _B, _P, _Q = ("px", "py"), ("lon", "lat"), ("122.3e0", "29.5e0"), ("122.3e0", "31.5e0")


@query(f"""WITH {POINTS_SQL}, l AS (SELECT *, lag(lon) OVER {_ORDER} AS px, lag(lat) OVER {_ORDER} AS py FROM points)
SELECT mmsi, count(*) AS crossings, min(t) AS t_first FROM l
WHERE {_area(_A, _B, _P)} * {_area(_A, _B, _Q)} <= 0 AND {_area(_P, _Q, _A)} * {_area(_P, _Q, _B)} <= 0 GROUP BY mmsi""")
def line_crossing(spark, sf_dir):
    crossed = tr.line_crossings(points(spark, sf_dir), (122.3, 29.5), (122.3, 31.5))
    return crossed.groupBy("mmsi").agg(F.count(F.lit(1)).alias("crossings"), F.min("t").alias("t_first"))


@query(f"WITH {_HITS} SELECT polygon, count(*) AS n_points, count(DISTINCT mmsi) AS n_ships FROM hits GROUP BY polygon")
def points_in_polygon(spark, sf_dir):
    hits = spatial.points_in_polygons(points(spark, sf_dir), polygons(spark))
    return hits.groupBy("polygon").agg(F.count(F.lit(1)).alias("n_points"), F.countDistinct("mmsi").alias("n_ships"))


_DWELL = f"""{_HITS}, every AS (
  SELECT g.polygon, p.mmsi, p.t, p.event_id, h.event_id IS NOT NULL AS inside
  FROM points p CROSS JOIN polygons g LEFT JOIN hits h ON h.event_id = p.event_id AND h.polygon = g.polygon
), steps AS (
  SELECT polygon, mmsi, t AS start, lead(t) OVER w AS stop, inside OR lead(inside) OVER w AS kept, row_number() OVER w AS i
  FROM every WINDOW w AS (PARTITION BY polygon, mmsi ORDER BY t, event_id)
), islands AS (SELECT *, i - row_number() OVER (PARTITION BY polygon, mmsi ORDER BY i) AS run FROM steps WHERE kept AND stop IS NOT NULL),
dwell AS (SELECT polygon, mmsi, min(start) AS t_first, max(stop) AS t_last, max(stop) - min(start) AS seconds FROM islands GROUP BY polygon, mmsi, run)"""


def _dwell(spark, sf_dir):
    p = points(spark, sf_dir)
    return tr.polygon_dwell(p, spatial.points_in_polygons(p, polygons(spark)).select("polygon", "mmsi", "event_id"))


@query(f"WITH {_DWELL} SELECT polygon, mmsi, t_first, t_last, seconds FROM dwell")
def polygon_dwell(spark, sf_dir):
    return _dwell(spark, sf_dir)


@query(f"""WITH {_DWELL} SELECT mmsi, CAST(coalesce(sum(seconds) FILTER (WHERE CAST(substr(polygon, 2) AS INTEGER) % 4 = 0), 0) AS BIGINT) AS dock_s,
CAST(coalesce(sum(seconds) FILTER (WHERE CAST(substr(polygon, 2) AS INTEGER) % 4 <> 0), 0) AS BIGINT) AS water_s FROM dwell GROUP BY mmsi""")
def dwell_by_class(spark, sf_dir):
    dock = F.substring("polygon", 2, 2).cast("int") % 4 == 0
    return _dwell(spark, sf_dir).groupBy("mmsi").agg(F.sum(F.when(dock, F.col("seconds")).otherwise(0)).alias("dock_s"), F.sum(F.when(dock, 0).otherwise(F.col("seconds"))).alias("water_s"))


@query(f"WITH {_DWELL} SELECT mmsi, polygon AS dock, CAST(sum(seconds) AS BIGINT) AS seconds, count(*) AS visits FROM dwell GROUP BY mmsi, polygon")
def dwell_by_dock(spark, sf_dir):
    return _dwell(spark, sf_dir).groupBy("mmsi", F.col("polygon").alias("dock")).agg(F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("visits"))


@query(f"WITH {_INSIDE} SELECT t // 600 * 600 AS slot, count(DISTINCT mmsi) AS n_ships FROM flagged WHERE inside GROUP BY 1")
def circle_counts_10m(spark, sf_dir):
    return _flagged(spark, sf_dir).filter("inside").groupBy(F.expr("t div 600 * 600").alias("slot")).agg(F.countDistinct("mmsi").alias("n_ships"))


_BINS = f"""{POINTS_SQL}, s AS (SELECT *, t - first(t) OVER {_ORDER} AS since FROM points),
bins AS (SELECT site, since // 43200 AS bin, sum(lon) AS sum_lon, sum(lat) AS sum_lat, count(*) AS n FROM s GROUP BY 1, 2)"""


def _bins(spark, sf_dir):
    shifted = tr.time_axis_shift(points(spark, sf_dir), 10**9)
    return tr.bin_means(shifted, ["site"], F.col("shift"), 43_200)


@query(f"WITH {_BINS} SELECT site, bin, n, round(sum_lon / n, 9) AS lon, round(sum_lat / n, 9) AS lat FROM bins")
def channel_fit(spark, sf_dir):
    return _bins(spark, sf_dir).select("site", "bin", "n", F.round(F.col("sum_lon") / F.col("n"), 9).alias("lon"), F.round(F.col("sum_lat") / F.col("n"), 9).alias("lat"))


@query(f"""WITH {_BINS} SELECT site, bin, round(sum(sum_lon) OVER w / sum(n) OVER w + 1e-10, 9) AS lon, round(sum(sum_lat) OVER w / sum(n) OVER w + 1e-10, 9) AS lat, CAST(sum(n) OVER w AS BIGINT) AS n
FROM bins WINDOW w AS (PARTITION BY site ORDER BY bin RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def channel_fit_smooth(spark, sf_dir):
    return tr.smoothed(_bins(spark, sf_dir), ["site"]).withColumns({"lon": F.round(F.col("lon") + 1e-10, 9), "lat": F.round(F.col("lat") + 1e-10, 9)})


@query(f"""WITH {POINTS_SQL}, v AS (SELECT *, CASE site WHEN 0 THEN 'A' WHEN 8 THEN 'B' WHEN 27 THEN 'C' END AS gate FROM points),
h AS (SELECT *, ntile(2) OVER {_ORDER} AS half FROM v WHERE gate IS NOT NULL)
SELECT mmsi FROM h GROUP BY mmsi HAVING bool_or(half = 1 AND gate = 'A') AND bool_or(half = 2 AND gate = 'B') AND NOT bool_or(gate NOT IN ('A', 'B'))""")
def gate_pairs(spark, sf_dir):
    """Over all points; a gate is one site, as a ship comes to 11 of the 35 at most in the tables and to all columns of them."""
    gated = points(spark, sf_dir).withColumn("gate", site_gate("site"))
    return tr.gate_pairs(gated.filter("gate is not null"), "A", "B")


@query(f"""WITH {POINTS_SQL} SELECT mmsi, round(max(lon) - min(lon), 6) AS lon_range, round(max(lat) - min(lat), 6) AS lat_range FROM points GROUP BY mmsi HAVING max(lon) - min(lon) > 1""")
def moving_ships(spark, sf_dir):
    ranges = points(spark, sf_dir).groupBy("mmsi").agg((F.max("lon") - F.min("lon")).alias("lon_range"), (F.max("lat") - F.min("lat")).alias("lat_range"))
    return ranges.filter("lon_range > 1").select("mmsi", F.round("lon_range", 6).alias("lon_range"), F.round("lat_range", 6).alias("lat_range"))


@query(f"""WITH RECURSIVE {_INSIDE}, hits AS (SELECT DISTINCT mmsi, t FROM flagged WHERE inside),
chain(mmsi, t) AS (SELECT mmsi, min(t) FROM hits GROUP BY mmsi UNION ALL
  SELECT c.mmsi, (SELECT min(h.t) FROM hits h WHERE h.mmsi = c.mmsi AND h.t - 5400 > c.t + 5400) FROM chain c WHERE c.t IS NOT NULL)
SELECT mmsi, t - 5400 AS t_from, t + 5400 AS t_to FROM chain WHERE t IS NOT NULL""")
def geofence_capture(spark, sf_dir):
    return tr.greedy_capture(_flagged(spark, sf_dir).filter("inside"))
