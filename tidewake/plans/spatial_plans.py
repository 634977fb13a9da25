"""Queries over compressed tracks and spatial classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewake.functions import geo
from tidewake.operators import clusters, compress
from tidewake.operators import trajectory as tr
from tidewake.plans.movement_plans import _STEPS
from tidewake.plans.registry import query
from tidewake.sources.fixtures import POINTS_SQL, haversine_sql, points, table

_ORDER = "(PARTITION BY mmsi ORDER BY t, event_id)"


def _length_sql(source: str) -> str:
    return f"""SELECT mmsi, round(coalesce(sum(step), 0), 6) AS km FROM (SELECT mmsi, {haversine_sql(f'lag(lon) OVER {_ORDER}', f'lag(lat) OVER {_ORDER}', 'lon', 'lat')} AS step FROM {source}) GROUP BY mmsi"""


@query(f"""WITH {_STEPS}, f AS (SELECT *, step_km * 1e6 / step_s > 300 AS fast FROM stepped), c AS (SELECT *, CASE WHEN fast <> lag(fast) OVER {_ORDER} THEN 1 ELSE 0 END AS change FROM f),
cut AS (SELECT *, sum(change) OVER {_ORDER} AS segment FROM c), i AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY mmsi, segment) AS n FROM cut WINDOW w AS (PARTITION BY mmsi, segment ORDER BY t, event_id)),
ends AS (SELECT * FROM i WHERE i = 1 OR i = n), a AS ({_length_sql('points')}), b AS ({_length_sql('ends')})
SELECT a.mmsi, round(CASE WHEN a.km > 0 THEN 1 - b.km / a.km ELSE 0 END, 6) AS deviation FROM a JOIN b ON a.mmsi = b.mmsi""")
def deviation(spark, sf_dir):
    """The loss where no height counts: the ends of the pieces between crossings of the speed threshold alone stay."""
    p = points(spark, sf_dir).select(*_TRACK)
    out = compress.deviation(tr.trip_distance(p), tr.trip_distance(compress.compressed(p, 1e9, "dp")))
    return out.select("mmsi", F.round("deviation", 6).alias("deviation"))


_TRACK = ("mmsi", "event_id", "t", "lon", "lat", "sog")


def _compressed(track, method, cut):
    return compress.compressed(track, 100.0, method, cut)


def _kept(spark, sf_dir, method, cut):
    return _compressed(points(spark, sf_dir).select(*_TRACK), method, cut).select("mmsi", "event_id", "t")


@query()
def compress_dp(spark, sf_dir):
    return _kept(spark, sf_dir, "dp", None)


@query()
def compress_ddp(spark, sf_dir):
    return _kept(spark, sf_dir, "ddp", 300.0)


@query()
def compress_sdp(spark, sf_dir):
    return _kept(spark, sf_dir, "sdp", 300.0)


@query()
def compress_qdp(spark, sf_dir):
    return _kept(spark, sf_dir, "qdp", 300.0)


@query()
def deviation_compressed(spark, sf_dir):
    """Per ship and method, the share of the distance that the registered compressions lose."""
    p = points(spark, sf_dir).select(*_TRACK)
    before = tr.trip_distance(p)
    lost = [
        compress.deviation(before, tr.trip_distance(_compressed(p, method, cut))).select("mmsi", F.lit(method).alias("method"), F.round("deviation", 6).alias("deviation"))
        for method, cut in (("dp", None), ("ddp", 300.0), ("sdp", 300.0), ("qdp", 300.0))
    ]
    return reduce(DataFrame.unionByName, lost)


@query(f"""WITH {POINTS_SQL}, s AS (SELECT mmsi, event_id, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS d, (t - lag(t) OVER w) * 0.001e0 AS dt FROM points WINDOW w AS {_ORDER})
SELECT mmsi, round(sum(sqrt(power(d, 2) + power(dt, 2))), 6) AS space_time_km FROM s GROUP BY mmsi""")
def space_time_distance(spark, sf_dir):
    before = lambda name: F.lag(name).over(tr.order())
    step = geo.space_time_km(before("lon"), before("lat"), before("t"), "lon", "lat", "t", 0.001)
    return points(spark, sf_dir).withColumn("step", step).groupBy("mmsi").agg(F.round(F.sum("step"), 6).alias("space_time_km"))


@query("""WITH v AS (SELECT c_custkey, CAST(c_custkey % 7 - 3 AS DOUBLE) AS ax, CAST(c_nationkey AS DOUBLE) AS ay, 2.0e0 AS az, CAST(c_custkey % 5 AS DOUBLE) AS bx, -1.0e0 AS by_, CAST(c_nationkey % 4 AS DOUBLE) AS bz FROM customer)
SELECT c_custkey, round((ax * bx + ay * by_ + az * bz) / nullif(sqrt((ax * ax + ay * ay + az * az) * (bx * bx + by_ * by_ + bz * bz)), 0), 6) AS cosine, ay * bz - az * by_ AS cross_x FROM v""")
def vector_angles(spark, sf_dir):
    d = lambda x: x.cast("double")
    a = F.array(d(F.col("c_custkey") % 7 - 3), d(F.col("c_nationkey")), F.lit(2.0))
    b = F.array(d(F.col("c_custkey") % 5), F.lit(-1.0), d(F.col("c_nationkey") % 4))
    c = table(spark, sf_dir, "customer").withColumns({"a": a, "b": b})
    return c.select("c_custkey", F.round(geo.cosine3("a", "b"), 6).alias("cosine"), geo.cross3("a", "b")[0].alias("cross_x"))


@query(f"""WITH {POINTS_SQL} SELECT mmsi, event_id FROM points WHERE lon BETWEEN 122 AND 123 AND lat BETWEEN 30.2e0 AND 30.8e0 AND status IN (0, 5) AND event_type NOT IN ('error')""")
def bbox_status_filter(spark, sf_dir):
    inside = F.col("lon").between(122, 123) & F.col("lat").between(30.2, 30.8)
    return points(spark, sf_dir).filter(inside & F.col("status").isin(0, 5) & ~F.col("event_type").isin("error")).select("mmsi", "event_id")


@query(f"WITH {POINTS_SQL} SELECT mmsi, count(*) AS n FROM points GROUP BY mmsi HAVING count(*) > 60 AND count(*) < 70")
def group_size_between(spark, sf_dir):
    return points(spark, sf_dir).groupBy("mmsi").agg(F.count(F.lit(1)).alias("n")).filter("n > 60 and n < 70")


@query(f"""WITH {POINTS_SQL} SELECT count(DISTINCT mmsi) AS ships_north, min(lat) > 30.9e0 AS all_north FROM points WHERE lat >= 30.9e0""")
def latitude_threshold(spark, sf_dir):
    return points(spark, sf_dir).filter("lat >= 30.9e0").agg(F.countDistinct("mmsi").alias("ships_north"), (F.min("lat") > 30.9).alias("all_north"))


@query(f"""WITH RECURSIVE berthed AS (SELECT c_custkey AS id, 121.0e0 + c_custkey * 7919 % 1000 * 0.001e0 AS lon, 30.0e0 + (c_custkey * 104729 + c_nationkey * 31) % 1000 * 0.001e0 AS lat FROM customer),
near AS (SELECT a.id, b.id AS other, {haversine_sql('a.lon', 'a.lat', 'b.lon', 'b.lat')} AS km FROM berthed a JOIN berthed b ON b.lat BETWEEN a.lat - 0.03 AND a.lat + 0.03 AND b.lon BETWEEN a.lon - 0.03 AND a.lon + 0.03),
reach AS (SELECT * FROM near WHERE km <= 2.0), core AS (SELECT id FROM reach GROUP BY id HAVING count(*) >= 4), link AS (SELECT id, other, km FROM reach WHERE other IN (SELECT id FROM core)),
walk AS (SELECT id, id AS root FROM core UNION SELECT l.other, w.root FROM walk w JOIN link l USING (id) WHERE l.other > w.root AND w.id IN (SELECT id FROM core)),
named AS (SELECT id, min(root) AS cluster FROM walk GROUP BY id),
border AS (SELECT l.id, arg_min(n.cluster, struct_pack(km := l.km, c := n.cluster)) AS cluster FROM link l JOIN named n ON n.id = l.other WHERE l.id NOT IN (SELECT id FROM core) GROUP BY l.id)
SELECT p.id, CASE WHEN n.id IS NOT NULL THEN 'core' WHEN b.id IS NOT NULL THEN 'border' ELSE 'noise' END AS kind, coalesce(n.cluster, b.cluster) AS cluster FROM berthed p LEFT JOIN named n USING (id) LEFT JOIN border b USING (id)""")
def density_clusters(spark, sf_dir):
    """Anchorages: clusters of ships at rest that lie four and more within two kilometres."""
    c = table(spark, sf_dir, "customer")
    at = c.select(F.col("c_custkey").alias("id"), (F.lit(121.0) + F.col("c_custkey") * 7919 % 1000 * F.lit(0.001)).alias("lon"), (F.lit(30.0) + (F.col("c_custkey") * 104729 + F.col("c_nationkey") * 31) % 1000 * F.lit(0.001)).alias("lat"))
    return clusters.density_clusters(at, 2.0, 4)
