"""Voyages from stops, and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.geo import haversine_km
from tidewake.operators.trajectory import steady_speed

DAY = 86_400


def gap_merge(stops: DataFrame, keys: list[str], gap_s: int) -> DataFrame:
    """Visits of one ship and port, stops less than ``gap_s`` apart taken together; the end is the last stop's."""
    w = Window.partitionBy(*keys).orderBy("begin_t", "end_t", "stop")
    apart = F.coalesce(F.col("begin_t") - F.lag("end_t").over(w) >= gap_s, F.lit(True))
    visits = stops.withColumn("visit", F.sum(F.when(apart, 1).otherwise(0)).over(w))
    last = F.max(F.struct("begin_t", "end_t", "stop")).alias("last")
    return visits.groupBy(*keys, "visit").agg(F.min("begin_t").alias("begin_t"), last, F.count(F.lit(1)).alias("n_stops")).select(*keys, "visit", "begin_t", F.col("last.end_t").alias("end_t"), "n_stops")


def drop_repeated_starts(rows: DataFrame, ship: str, start: str, order: list[str], kept: Column) -> DataFrame:
    """Rows that begin when the one before did go, unless either is ``kept``."""
    w = Window.partitionBy(ship).orderBy(start, *order)
    marked = rows.withColumn("kept", kept)
    same = (F.col(start) == F.lag(start).over(w)) & ~F.col("kept") & ~F.lag("kept").over(w)
    return marked.withColumn("same", F.coalesce(same, F.lit(False))).filter("not same").drop("same", "kept")


def same_port_merge(stops: DataFrame) -> DataFrame:
    """Consecutive stops at one port as one row."""
    w = Window.partitionBy("mmsi").orderBy("begin_t", "stop")
    moved = F.coalesce(F.col("site") != F.lag("site").over(w), F.lit(True))
    rows = stops.withColumn("call", F.sum(F.when(moved, 1).otherwise(0)).over(w))
    return rows.groupBy("mmsi", "call", "site").agg(F.min("begin_t").alias("begin_t"), F.max("end_t").alias("end_t"), F.count(F.lit(1)).alias("n_stops"), F.sum(F.col("end_t") - F.col("begin_t")).alias("stop_s"))


def voyage_legs(stops: DataFrame) -> DataFrame:
    """From one stop to the next at another port: when the ship left, when it arrived, and the seconds at sea."""
    w = Window.partitionBy("mmsi").orderBy("begin_t", "stop")
    after = lambda name: F.lead(name).over(w)
    legs = stops.select("mmsi", "stop", F.col("site").alias("start_site"), after("site").alias("end_site"), F.col("end_t").alias("start_t"), after("begin_t").alias("end_t"))
    return legs.filter("end_site is not null and end_site <> start_site and end_t > start_t").withColumn("sea_s", F.col("end_t") - F.col("start_t"))


def range_join(points: DataFrame, spans: DataFrame, bucket_s: int = DAY) -> DataFrame:
    """Points of a ship with its spans ``start_t <= t <= end_t``: an equi-join on ship and time bucket, so that long spans and ships split."""
    cut = spans.withColumn("bucket", F.explode(F.expr(f"sequence(start_t div {bucket_s}, end_t div {bucket_s})")))
    placed = points.withColumn("bucket", F.expr(f"t div {bucket_s}"))
    return placed.join(cut, ["mmsi", "bucket"]).filter("t between start_t and end_t").drop("bucket")


def leg_summary(points: DataFrame, legs: DataFrame) -> DataFrame:
    """Points, distance and draught of each leg; the draught is the later one where it changed exactly once."""
    w = Window.partitionBy("mmsi", "stop").orderBy("t", "event_id")
    met = range_join(points, legs)
    met = met.withColumn("step_km", haversine_km(F.lag("lon").over(w), F.lag("lat").over(w), "lon", "lat"))
    s = met.groupBy("mmsi", "stop").agg(
        F.count(F.lit(1)).alias("n_points"), F.coalesce(F.sum("step_km"), F.lit(0.0)).alias("distance_km"),
        F.countDistinct("draught").alias("draughts"), F.max(F.struct("t", "event_id", "draught")).alias("last"),
    )
    return s.select("mmsi", "stop", "n_points", "distance_km", F.when(F.col("draughts") == 2, F.col("last.draught")).alias("draught"))


def voyage_rows(points: DataFrame, stops: DataFrame, pair_kn: float = 5.0) -> DataFrame:
    """One row a voyage: the leg, the seconds in its port of departure and at sea, points, distance, draught, mean speed, and the speed at which it went steadily."""
    legs = voyage_legs(stops)
    spans = legs.select("mmsi", "stop", "start_t", "end_t")
    steady = steady_speed(range_join(points, spans), pair_kn, keys=("mmsi", "stop")).drop("n_marked")
    met = leg_summary(points, spans).join(steady, ["mmsi", "stop"], "left")
    port = stops.select("mmsi", "stop", (F.col("end_t") - F.col("begin_t")).alias("port_s"))
    out = legs.join(met, ["mmsi", "stop"]).join(port, ["mmsi", "stop"])
    speed = (F.col("distance_km") / (F.col("sea_s") / 3600)).alias("speed_kmh")
    return out.select("mmsi", "stop", "start_site", "end_site", "start_t", "end_t", "sea_s", "port_s", "n_points", "distance_km", "draught", speed, "steady_kn")


def merged_short_loops(voyages: DataFrame, km: float = 40.0) -> DataFrame:
    """Voyages of a ship with those from a port to itself of at most ``km`` taken into the next one: start, end, distance and how many."""
    w = Window.partitionBy("ship").orderBy("t", "voyage")
    loop = (F.col("start_port") == F.col("end_port")) & (F.col("distance") <= km)
    before = F.sum(F.when(loop, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = voyages.withColumn("leg", F.coalesce(before, F.lit(0)))
    first, last = F.min(F.struct("t", "voyage", "start_port")).alias("first"), F.max(F.struct("t", "voyage", "end_port")).alias("last")
    out = rows.groupBy("ship", "leg").agg(first, last, F.sum("distance").alias("distance"), F.count(F.lit(1)).alias("n_voyages"))
    return out.select("ship", "leg", F.col("first.voyage").alias("voyage"), "first.t", "first.start_port", "last.end_port", "distance", "n_voyages")


def two_way(routes: DataFrame) -> DataFrame:
    """Route counts folded over direction; ``routes`` has ``start_port, end_port, n``."""
    a, b = F.least("start_port", "end_port"), F.greatest("start_port", "end_port")
    there = F.col("start_port") == F.col("port_a")
    r = routes.withColumns({"port_a": a, "port_b": b}).filter("port_a <> port_b")
    return r.groupBy("port_a", "port_b").agg(F.sum(F.when(there, F.col("n")).otherwise(0)).alias("n_there"), F.sum(F.when(there, 0).otherwise(F.col("n"))).alias("n_back"), F.sum("n").alias("n"))


def closed_loops(voyages: DataFrame, port: int) -> DataFrame:
    """Per ship, the voyages from its first departure from ``port`` to its last arrival there: loops, mean distance and time, and the ports passed."""
    w = Window.partitionBy("ship").orderBy("t", "voyage")
    v = voyages.withColumn("i", F.row_number().over(w))
    ends = v.groupBy("ship").agg(F.min(F.when(F.col("start_port") == port, F.col("i"))).alias("a"), F.max(F.when(F.col("end_port") == port, F.col("i"))).alias("b")).filter("b >= a")
    inner = v.join(ends, "ship").filter("i between a and b")
    n = F.count_if(F.col("end_port") == port)
    path = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "end_port"))), lambda x: x["end_port"].cast("string")), "*")
    return inner.groupBy("ship").agg(n.alias("loops"), (F.sum("distance") / n).alias("loop_distance"), ((F.max("t") - F.min("t")) / n).alias("loop_s"), path.alias("path"))


def route_class(path: Column, classes: list[tuple[str, list[str]]]) -> Column:
    """The first class all of whose ports stand in a ``a*b*c`` path."""
    ports = F.split(path, r"\*")
    out = F.lit("other")
    for name, needed in reversed(classes):
        held = F.lit(True)
        for p in needed:
            held = held & F.array_contains(ports, p)
        out = F.when(held, F.lit(name)).otherwise(out)
    return out


def fleet_utilisation(points: DataFrame, stops: DataFrame, distance: DataFrame, idle_s: int = 10 * DAY, leg_stop_s: int = DAY // 2) -> DataFrame:
    """Seconds in all, under way and in work, mean speed under way and legs per ship."""
    spans = points.groupBy("mmsi").agg((F.max("t") - F.min("t")).alias("all_s"))
    length = F.col("end_t") - F.col("begin_t")
    still = stops.groupBy("mmsi").agg(F.sum(length).alias("stop_s"), F.sum(F.when(length > idle_s, length).otherwise(0)).alias("idle_s"))
    calls = same_port_merge(stops).groupBy("mmsi").agg(F.count_if(F.col("stop_s") > leg_stop_s).alias("calls"))
    nought = lambda name: F.coalesce(F.col(name), F.lit(0))
    run = F.col("all_s") - nought("stop_s")
    joined = spans.join(still, "mmsi", "left").join(calls, "mmsi", "left").join(distance, "mmsi", "left")
    return joined.select(
        "mmsi", "all_s", run.alias("run_s"), (F.col("all_s") - nought("idle_s")).alias("work_s"),
        F.when(run > 0, F.col("distance_km") / (run / 3600)).otherwise(0.0).alias("speed_kmh"), F.greatest(nought("calls") - 1, F.lit(0)).alias("legs"),
    )
