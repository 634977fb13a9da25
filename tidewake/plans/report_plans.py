"""Queries over voyages and the reports made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewake.operators import stops as st
from tidewake.operators import trajectory as tr
from tidewake.operators import voyages as vo
from tidewake.plans.registry import query
from tidewake.plans.stop_plans import STOPS_SQL
from tidewake.sources.fixtures import POINTS_SQL, VOYAGES_SQL, haversine_sql, points, table, voyages

_R = f"WITH RECURSIVE {STOPS_SQL}"


def _calls(spark, sf_dir):
    return st.summarised(st.stop_members(points(spark, sf_dir)), "site")


def _gap_sql(gap: int) -> str:
    return f"""{_R}, g AS (SELECT *, CASE WHEN begin_t - lag(end_t) OVER w < {gap} THEN 0 ELSE 1 END AS apart FROM stops WINDOW w AS (PARTITION BY mmsi, site ORDER BY begin_t, end_t, stop)),
v AS (SELECT *, sum(apart) OVER (PARTITION BY mmsi, site ORDER BY begin_t, end_t, stop) AS visit FROM g)
SELECT mmsi, site, CAST(visit AS BIGINT) AS visit, min(begin_t) AS begin_t, arg_max(end_t, begin_t) AS end_t, count(*) AS n_stops FROM v GROUP BY mmsi, site, visit"""


@query(_gap_sql(1800))
def gap_merge_30m(spark, sf_dir):
    return vo.gap_merge(_calls(spark, sf_dir), ["mmsi", "site"], 1800)


@query(_gap_sql(86400))
def gap_merge_24h(spark, sf_dir):
    return vo.gap_merge(_calls(spark, sf_dir), ["mmsi", "site"], vo.DAY)


@query(f"""WITH {VOYAGES_SQL}, m AS (SELECT *, start_port IN (3, 7) AS kept FROM voyages),
s AS (SELECT *, coalesce(t = lag(t) OVER w AND NOT kept AND NOT lag(kept) OVER w, false) AS same FROM m WINDOW w AS (PARTITION BY ship ORDER BY t, voyage))
SELECT ship, voyage, t FROM s WHERE NOT same""")
def dup_start_drop(spark, sf_dir):
    return vo.drop_repeated_starts(voyages(spark, sf_dir), "ship", "t", ["voyage"], F.col("start_port").isin(3, 7)).select("ship", "voyage", "t")


_LEGS = f"""{_R}, legs AS MATERIALIZED (
  SELECT *, end_t - start_t AS sea_s FROM (SELECT mmsi, stop, site AS start_site, lead(site) OVER w AS end_site, end_t AS start_t, lead(begin_t) OVER w AS end_t
    FROM stops WINDOW w AS (PARTITION BY mmsi ORDER BY begin_t, stop)) WHERE end_site <> start_site AND end_t > start_t
), met AS (SELECT p.*, l.stop, l.start_t, l.end_t FROM points p JOIN legs l ON p.mmsi = l.mmsi AND p.t BETWEEN l.start_t AND l.end_t)"""


@query(f"{_LEGS} SELECT mmsi, stop, start_site, end_site, start_t, end_t, sea_s FROM legs")
def voyage_legs(spark, sf_dir):
    return vo.voyage_legs(_calls(spark, sf_dir))


@query(f"{_LEGS} SELECT mmsi, stop, count(*) AS n_points, min(event_id) AS first_event FROM met GROUP BY mmsi, stop")
def leg_points(spark, sf_dir):
    met = vo.range_join(points(spark, sf_dir), vo.voyage_legs(_calls(spark, sf_dir)).select("mmsi", "stop", "start_t", "end_t"))
    return met.groupBy("mmsi", "stop").agg(F.count(F.lit(1)).alias("n_points"), F.min("event_id").alias("first_event"))


def _legs(spark, sf_dir):
    return vo.leg_summary(points(spark, sf_dir), vo.voyage_legs(_calls(spark, sf_dir)).select("mmsi", "stop", "start_t", "end_t"))


@query(f"""{_LEGS}, s AS (SELECT *, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS step FROM met WINDOW w AS (PARTITION BY mmsi, stop ORDER BY t, event_id))
SELECT mmsi, stop, n_points, round(coalesce(d, 0), 6) AS distance_km FROM (SELECT mmsi, stop, count(*) AS n_points, sum(step) AS d FROM s GROUP BY mmsi, stop)""")
def leg_distance(spark, sf_dir):
    return _legs(spark, sf_dir).select("mmsi", "stop", "n_points", F.round("distance_km", 6).alias("distance_km"))


@query(f"{_LEGS} SELECT mmsi, stop, CASE WHEN count(DISTINCT draught) = 2 THEN last(draught ORDER BY t, event_id) END AS draught FROM met GROUP BY mmsi, stop")
def leg_draught(spark, sf_dir):
    return _legs(spark, sf_dir).select("mmsi", "stop", "draught")


_CALLS = f"""{_R}, m AS (SELECT *, CASE WHEN site = lag(site) OVER w THEN 0 ELSE 1 END AS moved FROM stops WINDOW w AS (PARTITION BY mmsi ORDER BY begin_t, stop)),
c AS (SELECT *, sum(moved) OVER (PARTITION BY mmsi ORDER BY begin_t, stop) AS call FROM m),
calls AS (SELECT mmsi, CAST(call AS BIGINT) AS call, site, min(begin_t) AS begin_t, max(end_t) AS end_t, count(*) AS n_stops, CAST(sum(end_t - begin_t) AS BIGINT) AS stop_s FROM c GROUP BY mmsi, call, site)"""


@query(f"{_CALLS} SELECT * FROM calls")
def same_port_merge(spark, sf_dir):
    return vo.same_port_merge(_calls(spark, sf_dir))


@query(f"""{_CALLS}, st AS (SELECT *, {haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} AS step FROM points WINDOW w AS (PARTITION BY mmsi ORDER BY t, event_id)),
a AS (SELECT mmsi, max(t) - min(t) AS all_s, round(coalesce(sum(step), 0), 6) AS km FROM st GROUP BY mmsi),
s AS (SELECT mmsi, sum(end_t - begin_t) AS stop_s, sum(CASE WHEN end_t - begin_t > 172800 THEN end_t - begin_t ELSE 0 END) AS idle_s FROM stops GROUP BY mmsi),
k AS (SELECT mmsi, count(*) FILTER (WHERE stop_s > 43200) AS n FROM calls GROUP BY mmsi)
SELECT a.mmsi, all_s, CAST(all_s - coalesce(stop_s, 0) AS BIGINT) AS run_s, CAST(all_s - coalesce(idle_s, 0) AS BIGINT) AS work_s,
round(CASE WHEN all_s - coalesce(stop_s, 0) > 0 THEN km / ((all_s - coalesce(stop_s, 0)) / 3600) ELSE 0 END, 6) AS speed_kmh, greatest(coalesce(n, 0) - 1, 0) AS legs
FROM a LEFT JOIN s USING (mmsi) LEFT JOIN k USING (mmsi)""")
def fleet_utilisation(spark, sf_dir):
    p = points(spark, sf_dir)
    out = vo.fleet_utilisation(p, _calls(spark, sf_dir), tr.trip_distance(p).select("mmsi", "distance_km"), idle_s=2 * vo.DAY)
    return out.withColumn("speed_kmh", F.round("speed_kmh", 6))


@query(f"""{_R}, g AS (SELECT mmsi, lead(begin_t) OVER (PARTITION BY mmsi ORDER BY begin_t, stop) - end_t AS gap FROM stops)
SELECT mmsi, count(*) FILTER (WHERE gap > 43200) AS long_gaps FROM g GROUP BY mmsi""")
def long_gaps(spark, sf_dir):
    from pyspark.sql import Window

    gap = F.lead("begin_t").over(Window.partitionBy("mmsi").orderBy("begin_t", "stop")) - F.col("end_t")
    return _calls(spark, sf_dir).withColumn("gap", gap).groupBy("mmsi").agg(F.count_if(F.col("gap") > 43_200).alias("long_gaps"))


@query(f"WITH {VOYAGES_SQL} SELECT n_name AS port_name, count(*) AS n_voyages, min(voyage) AS first_voyage FROM voyages JOIN nation ON n_nationkey = end_port GROUP BY n_name")
def port_ranking(spark, sf_dir):
    counted = voyages(spark, sf_dir).groupBy("end_port").agg(F.count(F.lit(1)).alias("n_voyages"), F.min("voyage").alias("first_voyage"))
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("end_port"), F.col("n_name").alias("port_name"))
    return counted.join(names, "end_port").select("port_name", "n_voyages", "first_voyage")


@query(f"WITH {VOYAGES_SQL} SELECT end_port, count(*) AS n_voyages FROM voyages GROUP BY end_port ORDER BY n_voyages DESC, end_port LIMIT 10")
def top_ports(spark, sf_dir):
    return voyages(spark, sf_dir).groupBy("end_port").agg(F.count(F.lit(1)).alias("n_voyages")).orderBy(F.desc("n_voyages"), "end_port").limit(10)


def _routes(spark, sf_dir):
    return voyages(spark, sf_dir).groupBy("start_port", "end_port").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {VOYAGES_SQL} SELECT start_port, end_port, count(*) AS n FROM voyages GROUP BY start_port, end_port")
def route_counts(spark, sf_dir):
    return _routes(spark, sf_dir)


@query(f"""WITH {VOYAGES_SQL} SELECT least(start_port, end_port) AS port_a, greatest(start_port, end_port) AS port_b, count(*) FILTER (WHERE start_port < end_port) AS n_there,
count(*) FILTER (WHERE start_port > end_port) AS n_back, count(*) AS n FROM voyages WHERE start_port <> end_port GROUP BY 1, 2""")
def route_two_way(spark, sf_dir):
    return vo.two_way(_routes(spark, sf_dir))


@query(f"WITH {VOYAGES_SQL} SELECT end_port, CAST(sum(teu) AS BIGINT) AS turnover, count(*) AS visits FROM voyages GROUP BY end_port")
def port_turnover(spark, sf_dir):
    return voyages(spark, sf_dir).groupBy("end_port").agg(F.sum("teu").alias("turnover"), F.count(F.lit(1)).alias("visits"))


@query(f"WITH {VOYAGES_SQL} SELECT start_port, end_port, count(*) AS visits, round(avg(distance) + 1e-7, 4) AS mean_distance, round(sum(teu * distance), 2) AS teu_distance FROM voyages GROUP BY start_port, end_port")
def route_summary(spark, sf_dir):
    return voyages(spark, sf_dir).groupBy("start_port", "end_port").agg(F.count(F.lit(1)).alias("visits"), F.round(F.avg("distance") + 1e-7, 4).alias("mean_distance"), F.round(F.sum(F.col("teu") * F.col("distance")), 2).alias("teu_distance"))


_HIST = f"{POINTS_SQL}, hist AS (SELECT draught, CAST(trunc(sog + 0.5e0) AS BIGINT) AS speed, count(*) AS n FROM points GROUP BY 1, 2)"


def _hist(spark, sf_dir):
    return points(spark, sf_dir).groupBy("draught", (F.col("sog") + 0.5).cast("long").alias("speed")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_HIST} SELECT * FROM hist")
def draught_speed_hist(spark, sf_dir):
    return _hist(spark, sf_dir)


@query(f"WITH {_HIST} SELECT draught // 10 AS band, round(avg(speed), 6) AS mean_speed, CAST(sum(n) AS BIGINT) AS n FROM hist GROUP BY 1")
def draught_band(spark, sf_dir):
    return _hist(spark, sf_dir).groupBy(F.expr("draught div 10").alias("band")).agg(F.round(F.avg("speed"), 6).alias("mean_speed"), F.sum("n").alias("n"))


@query(f"""WITH {VOYAGES_SQL}, v AS (SELECT ship, t, voyage, distance, end_port, lag(end_port, 1, ship % 25) OVER w AS start_port, row_number() OVER w AS i FROM voyages WINDOW w AS (PARTITION BY ship ORDER BY t, voyage)),
e AS (SELECT ship, min(i) FILTER (WHERE start_port = 7) AS a, max(i) FILTER (WHERE end_port = 7) AS b FROM v GROUP BY ship)
SELECT ship, count(*) FILTER (WHERE end_port = 7) AS loops, round(sum(distance) / count(*) FILTER (WHERE end_port = 7), 4) AS loop_distance,
round((max(t) - min(t)) / count(*) FILTER (WHERE end_port = 7), 4) AS loop_s, string_agg(CAST(end_port AS VARCHAR), '*' ORDER BY i) AS path
FROM v JOIN e USING (ship) WHERE i BETWEEN a AND b GROUP BY ship""")
def closed_loops(spark, sf_dir):
    out = vo.closed_loops(_chained(spark, sf_dir), 7)
    return out.withColumns({"loop_distance": F.round("loop_distance", 4), "loop_s": F.round("loop_s", 4)})


def _chained(spark, sf_dir):
    """Voyages that begin where the ship's last one ended."""
    from pyspark.sql import Window

    w = Window.partitionBy("ship").orderBy("t", "voyage")
    return voyages(spark, sf_dir).withColumn("start_port", F.coalesce(F.lag("end_port").over(w), F.col("ship") % 25))


@query(f"""WITH {VOYAGES_SQL}, v AS (SELECT ship, t, voyage, distance / 50 AS distance, end_port, lag(end_port, 1, ship % 25) OVER w AS start_port FROM voyages WINDOW w AS (PARTITION BY ship ORDER BY t, voyage)),
l AS (SELECT *, start_port = end_port AND distance <= 40 AS is_loop FROM v), g AS (SELECT *, coalesce(sum(CASE WHEN is_loop THEN 0 ELSE 1 END) OVER (PARTITION BY ship ORDER BY t, voyage ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS leg FROM l)
SELECT ship, CAST(leg AS BIGINT) AS leg, arg_min(voyage, (t, voyage)) AS voyage, min(t) AS t, arg_min(start_port, (t, voyage)) AS start_port, arg_max(end_port, (t, voyage)) AS end_port, round(sum(distance) + 1e-7, 4) AS distance, count(*) AS n_voyages
FROM g GROUP BY ship, leg""")
def short_loop_merge(spark, sf_dir):
    v = _chained(spark, sf_dir).withColumn("distance", F.col("distance") / 50)
    return vo.merged_short_loops(v).withColumn("distance", F.round(F.col("distance") + 1e-7, 4))


_CLASSES = [("west", ["7", "3"]), ("east", ["12"]), ("north", ["1"])]


@query(f"""WITH {VOYAGES_SQL}, p AS (SELECT ship, string_agg(CAST(end_port AS VARCHAR), '*' ORDER BY t, voyage) AS path FROM voyages GROUP BY ship), s AS (SELECT ship, string_split(path, '*') AS ports FROM p)
SELECT ship, CASE WHEN list_contains(ports, '7') AND list_contains(ports, '3') THEN 'west' WHEN list_contains(ports, '12') THEN 'east' WHEN list_contains(ports, '1') THEN 'north' ELSE 'other' END AS route FROM s""")
def route_flags(spark, sf_dir):
    path = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("t", "voyage", "end_port"))), lambda x: x["end_port"].cast("string")), "*")
    return voyages(spark, sf_dir).groupBy("ship").agg(path.alias("path")).select("ship", vo.route_class(F.col("path"), _CLASSES).alias("route"))
