"""Queries over stops; the SQL twins run the greedy scan as a recursion of one row a step."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewake.operators import spatial, stops
from tidewake.plans.registry import query
from tidewake.sources.fixtures import POINTS_SQL, POLYGONS_SQL, PORTS_SQL, cell_sql, haversine_sql, points, polygons, ports

_GROWN = haversine_sql("least(f.x0, p.lon2)", "least(f.y0, p.lat2)", "greatest(f.x1, p.lon2)", "greatest(f.y1, p.lat2)")
_PAIR = haversine_sql("least(lon, lon2)", "least(lat, lat2)", "greatest(lon, lon2)", "greatest(lat, lat2)")

#: Tables seq (points with their number i of n) and found (mmsi, first and last number of each stop).
STOPS_SQL = f"""{POINTS_SQL}, seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY t, event_id) AS i, count(*) OVER (PARTITION BY mmsi) AS n FROM points
), pairs AS MATERIALIZED (
  SELECT mmsi, i, n, lon, lat, lon2, lat2, slow, slow AND {_PAIR} * 1e6 <= 282842.712474619e0 AS still FROM (
    SELECT *, {haversine_sql('lon', 'lat', 'lon2', 'lat2')} * 1e6 / greatest(t2 - t, 1) <= 100 AS slow FROM (
      SELECT *, lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2, lead(t) OVER w AS t2 FROM seq WINDOW w AS (PARTITION BY mmsi ORDER BY i)) WHERE t2 IS NOT NULL)
), fold(mmsi, i, n, s, x0, x1, y0, y1, e_from, e_to) AS (
  SELECT mmsi, i, n, i, lon, lon, lat, lat, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM seq WHERE i = 1
  UNION ALL
  SELECT mmsi, i + 1, n, CASE WHEN ok1 THEN s WHEN ok2 THEN i ELSE i + 1 END,
         CASE WHEN ok1 THEN least(x0, lon2) WHEN ok2 THEN least(lon, lon2) ELSE lon2 END, CASE WHEN ok1 THEN greatest(x1, lon2) WHEN ok2 THEN greatest(lon, lon2) ELSE lon2 END,
         CASE WHEN ok1 THEN least(y0, lat2) WHEN ok2 THEN least(lat, lat2) ELSE lat2 END, CASE WHEN ok1 THEN greatest(y1, lat2) WHEN ok2 THEN greatest(lat, lat2) ELSE lat2 END,
         CASE WHEN NOT ok1 AND i > s THEN s END, CASE WHEN NOT ok1 AND i > s THEN i END
  FROM (SELECT f.*, p.lon, p.lat, p.lon2, p.lat2, p.slow AND {_GROWN} * 1e6 <= 282842.712474619e0 AS ok1, p.still AS ok2 FROM fold f JOIN pairs p ON p.mmsi = f.mmsi AND p.i = f.i)
), found AS MATERIALIZED (
  SELECT mmsi, e_from AS i_from, e_to AS i_to FROM fold WHERE e_from IS NOT NULL
  UNION ALL SELECT mmsi, s, n FROM fold WHERE i = n AND n > s
), stops AS MATERIALIZED (
  SELECT f.mmsi, row_number() OVER (PARTITION BY f.mmsi ORDER BY i_from) - 1 AS stop, a.t AS begin_t, b.t AS end_t,
         a.lon AS begin_lon, a.lat AS begin_lat, b.lon AS end_lon, b.lat AS end_lat, i_to - i_from + 1 AS point_num, a.site AS site, i_from, i_to
  FROM found f JOIN seq a ON a.mmsi = f.mmsi AND a.i = i_from JOIN seq b ON b.mmsi = f.mmsi AND b.i = i_to
), centred AS MATERIALIZED (
  SELECT s.mmsi, s.stop, any_value(begin_t) AS begin_t, any_value(end_t) AS end_t, avg(q.lon) AS lon, avg(q.lat) AS lat
  FROM stops s JOIN seq q ON q.mmsi = s.mmsi AND q.i BETWEEN i_from AND i_to GROUP BY s.mmsi, s.stop
)"""
MERGED_SQL = f"""{STOPS_SQL}, gaps AS (
  SELECT *, CASE WHEN {haversine_sql('lag(end_lon) OVER w', 'lag(end_lat) OVER w', 'begin_lon', 'begin_lat')} <= 0.1e0 OR begin_t - lag(end_t) OVER w <= 1800 THEN 0 ELSE 1 END AS starts
  FROM stops WINDOW w AS (PARTITION BY mmsi ORDER BY stop)
), numbered AS (SELECT *, sum(starts) OVER (PARTITION BY mmsi ORDER BY stop) AS merged FROM gaps)"""


def _members(spark, sf_dir):
    return stops.stop_members(points(spark, sf_dir))


def _stops(spark, sf_dir):
    return stops.summarised(_members(spark, sf_dir))


@query(f"WITH RECURSIVE {STOPS_SQL} SELECT mmsi, stop, begin_t, end_t, round(begin_lon, 6) AS begin_lon, round(begin_lat, 6) AS begin_lat, round(end_lon, 6) AS end_lon, round(end_lat, 6) AS end_lat, point_num FROM stops")
def stops_raw(spark, sf_dir):
    rounded = [F.round(c, 6).alias(c) for c in ("begin_lon", "begin_lat", "end_lon", "end_lat")]
    return _stops(spark, sf_dir).select("mmsi", "stop", "begin_t", "end_t", *rounded, "point_num")


@query(f"WITH RECURSIVE {MERGED_SQL} SELECT mmsi, CAST(merged AS BIGINT) AS merged, min(begin_t) AS begin_t, max(end_t) AS end_t, CAST(sum(point_num) AS BIGINT) AS point_num, count(*) AS n_stops FROM numbered GROUP BY mmsi, merged")
def stops_merged(spark, sf_dir):
    return stops.merged_stops(_stops(spark, sf_dir))


@query(f"""WITH RECURSIVE {STOPS_SQL}, m AS (SELECT s.stop, q.* FROM stops s JOIN seq q ON q.mmsi = s.mmsi AND q.i BETWEEN i_from AND i_to),
a AS (SELECT mmsi, stop, min(t) AS begin_t, max(t) AS end_t, count(*) AS point_num, round(avg(sog), 6) AS avg_sog, round(var_pop(sog), 6) AS var_sog, max(sog) AS max_sog,
  first(cog ORDER BY sog DESC, t, event_id) AS max_sog_cog, round(var_pop(head), 6) AS var_hdg, round(var_pop(cog), 6) AS var_cog, round(avg(head - cog), 6) AS avg_hdg_cog,
  CASE WHEN count(DISTINCT draught) = 2 THEN last(draught ORDER BY t, event_id) END AS draught, last(status ORDER BY t, event_id) AS navistate FROM m GROUP BY mmsi, stop)
SELECT *, begin_t - lag(end_t) OVER (PARTITION BY mmsi ORDER BY stop) AS apart_s FROM a""")
def stop_stats(spark, sf_dir):
    s = stops.stop_statistics(_members(spark, sf_dir))
    return s.withColumns({c: F.round(c, 6) for c in ("avg_sog", "var_sog", "var_hdg", "var_cog", "avg_hdg_cog")})


_REACH = f"""near AS (SELECT s.mmsi, s.stop, p.port, p.level, {haversine_sql('s.lon', 's.lat', 'p.port_lon', 'p.port_lat')} AS km FROM centred s CROSS JOIN ports p)"""


@query(f"""WITH RECURSIVE {STOPS_SQL}, {PORTS_SQL}, {_REACH}
SELECT mmsi, stop, port, level, round(km, 6) AS port_km FROM near WHERE km < 25 QUALIFY row_number() OVER (PARTITION BY mmsi, stop ORDER BY km, port) = 1""")
def nearest_port_grid(spark, sf_dir):
    near = spatial.nearest_port(_stops(spark, sf_dir), ports(spark), ["mmsi", "stop"])
    return near.withColumn("port_km", F.round("port_km", 6))


@query(f"""WITH RECURSIVE {STOPS_SQL}, {PORTS_SQL}, {_REACH}
SELECT mmsi, stop, port, level, round(km, 6) AS port_km FROM near WHERE km < 20 QUALIFY row_number() OVER (PARTITION BY mmsi, stop ORDER BY km, port) = 1""")
def nearest_port_brute(spark, sf_dir):
    """The exhaustive search over all ports of a wide box."""
    near = spatial.nearest_port_boxed(_stops(spark, sf_dir), ports(spark), ["mmsi", "stop"])
    return near.withColumn("port_km", F.round("port_km", 6))


@query(f"""WITH RECURSIVE {STOPS_SQL}, {PORTS_SQL}, {_REACH}
SELECT mmsi, stop, port, level, round(km, 6) AS port_km FROM near WHERE km < 60 QUALIFY row_number() OVER (PARTITION BY mmsi, stop ORDER BY level DESC, km, port) = 1""")
def port_priority(spark, sf_dir):
    near = spatial.nearest_port(_stops(spark, sf_dir), ports(spark), ["mmsi", "stop"], radius_km=60.0, by_level=True)
    return near.withColumn("port_km", F.round("port_km", 6))


@query(f"""WITH RECURSIVE {STOPS_SQL}, {POLYGONS_SQL}, {PORTS_SQL}, {_REACH},
inside AS (SELECT s.mmsi, s.stop, min(g.polygon) AS polygon FROM (SELECT mmsi, stop, round(lon, 7) AS lon, round(lat, 7) AS lat FROM centred) s JOIN polygons g ON s.lon > g.west AND s.lon <= g.east AND s.lat >= g.south AND s.lat < g.north GROUP BY 1, 2),
best AS (SELECT * FROM near WHERE km < 25e0 QUALIFY row_number() OVER (PARTITION BY mmsi, stop ORDER BY km, port) = 1)
SELECT s.mmsi, s.stop, i.polygon, CASE WHEN i.polygon IS NULL THEN b.port END AS port FROM centred s
LEFT JOIN inside i ON i.mmsi = s.mmsi AND i.stop = s.stop LEFT JOIN best b ON b.mmsi = s.mmsi AND b.stop = s.stop""")
def stop_port(spark, sf_dir):
    placed = _stops(spark, sf_dir).withColumns({"lon": F.round("lon", 7), "lat": F.round("lat", 7)})
    found = spatial.stop_ports(placed, polygons(spark), ports(spark), ["mmsi", "stop"])
    return found.select("mmsi", "stop", "polygon", "port")


@query(f"WITH RECURSIVE {STOPS_SQL} SELECT {cell_sql('lon', 'lat')} AS cell, count(*) AS n_stops, CAST(sum(end_t - begin_t) AS BIGINT) AS seconds FROM centred GROUP BY 1")
def stop_density(spark, sf_dir):
    from tidewake.functions.geo import cell_id

    return _stops(spark, sf_dir).groupBy(cell_id("lon", "lat").alias("cell")).agg(F.count(F.lit(1)).alias("n_stops"), F.sum(F.col("end_t") - F.col("begin_t")).alias("seconds"))
