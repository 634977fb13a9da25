"""Operators over the ordered positions of a ship: columns ``mmsi, event_id, t, lon, lat, sog``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.geo import haversine_km, lines_cross, planar_bearing
from tidewake.operators.slices import any_longer, homed

KMH_PER_KNOT = 1.852
#: A ship with more rows is scanned by several tasks, cut somewhere in each slice of so many seconds.
LONGEST, SLICE_S = 1 << 22, 604_800


def order(keys: tuple[str, ...] = ("mmsi",)):
    """Positions of a ship, or of a part of its track, in time, identifiers breaking ties."""
    return Window.partitionBy(*keys).orderBy("t", "event_id")


def stepped(points: DataFrame, keys: tuple[str, ...] = ("mmsi",)) -> DataFrame:
    """Each point with the distance and time from the one before: ``step_km, step_s``; no time counts as a second."""
    before = lambda name: F.lag(name).over(order(keys))
    return points.withColumns({
        "step_km": haversine_km(before("lon"), before("lat"), "lon", "lat"),
        "step_s": F.greatest(F.col("t") - before("t"), F.lit(1)),
    })


def trip_distance(points: DataFrame) -> DataFrame:
    return stepped(points).groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_points"), F.round(F.coalesce(F.sum("step_km"), F.lit(0.0)), 6).alias("distance_km"))


def pair_speed(points: DataFrame) -> DataFrame:
    speed = F.col("step_km") / F.col("step_s") * 3600
    return stepped(points).groupBy("mmsi").agg(F.round(F.avg(speed), 6).alias("mean_kmh"), F.round(F.max(speed), 6).alias("max_kmh"))


def steady_speed(points: DataFrame, pair_kn: float = 5.0, own_kn: float = 5.0, slowing_kn_s: float = 0.01, keys: tuple[str, ...] = ("mmsi",)) -> DataFrame:
    """Mean speed of the points at an end of a steady pair; null with fewer than two of them; by ship, or by other ``keys``."""
    s = stepped(points, keys).withColumn("sog_before", F.lag("sog").over(order(keys)))
    steady = (
        (F.col("step_km") / F.col("step_s") * 3600 / KMH_PER_KNOT > pair_kn)
        & (F.col("sog") > own_kn)
        & (F.col("sog_before") > own_kn)
        & ((F.col("sog_before") - F.col("sog")) / F.col("step_s") < slowing_kn_s)
    )
    s = s.withColumn("steady", F.coalesce(steady, F.lit(False)))
    s = s.withColumn("marked", F.col("steady") | F.coalesce(F.lead("steady").over(order(keys)), F.lit(False)))
    n = F.count_if("marked")
    return s.groupBy(*keys).agg(n.alias("n_marked"), F.when(n > 1, F.round(F.avg(F.when(F.col("marked"), F.col("sog"))), 6)).alias("steady_kn"))


def antimeridian_split(points: DataFrame, jump: float = 200.0) -> DataFrame:
    """A line number per ship that advances where longitude jumps."""
    cut = F.abs(F.col("lon") - F.lag("lon").over(order())) > jump
    return points.withColumn("line", F.sum(F.when(cut, 1).otherwise(0)).over(order()))


def latest_position(points: DataFrame, *columns: str) -> DataFrame:
    """The newest row of each ship; later identifiers win ties."""
    row = F.max(F.struct("t", "event_id", *columns)).alias("row")
    return points.groupBy("mmsi").agg(row).select("mmsi", "row.*")


def time_axis_shift(points: DataFrame, span: int) -> DataFrame:
    """Seconds since the ship's first point, wrapped at ``span``, and how often it wrapped."""
    since = F.col("t") - F.first("t").over(order())
    return points.withColumns({"shift": since % span, "lap": F.floor(since / span).cast("long")})


def fit_bearing(points: DataFrame) -> DataFrame:
    """Planar bearing towards the next point; 0 for the last one and where longitude stays."""
    ahead = planar_bearing("lon", "lat", F.lead("lon").over(order()), F.lead("lat").over(order()))
    return points.withColumn("bearing", F.round(F.coalesce(ahead, F.lit(0.0)), 6))


def speed_cut(points: DataFrame, mm_s: float = 300.0) -> DataFrame:
    """A segment number that advances where the pair speed crosses the threshold."""
    s = stepped(points).withColumn("fast", F.col("step_km") * 1e6 / F.col("step_s") > mm_s)
    change = F.coalesce(F.col("fast") != F.lag("fast").over(order()), F.lit(False))
    return s.withColumn("segment", F.sum(F.when(change, 1).otherwise(0)).over(order()))


def inside_runs(flagged: DataFrame) -> DataFrame:
    """A run number that advances on each outside point, for rows with a boolean ``inside``."""
    return flagged.withColumn("run", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(order()))


def carry_forward(rows: DataFrame, column: str) -> DataFrame:
    """The last known value of ``column`` of the ship."""
    return rows.withColumn("carried", F.last(column, ignorenulls=True).over(order().rowsBetween(Window.unboundedPreceding, 0)))


def prefix_until_exit(flagged: DataFrame) -> DataFrame:
    """Rows of each ship up to the first point outside that follows one inside."""
    left = F.coalesce(F.lag("inside").over(order()) & ~F.col("inside"), F.lit(False))
    return flagged.withColumn("left", left).withColumn("exits", F.sum(F.when(F.col("left"), 1).otherwise(0)).over(order())).filter("exits = 0").drop("left", "exits")


def line_crossings(points: DataFrame, a: tuple[float, float], b: tuple[float, float]) -> DataFrame:
    """Steps that cross or touch the segment from ``a`` to ``b``."""
    before = lambda name: F.lag(name).over(order())
    return points.withColumn("crosses", F.coalesce(lines_cross(before("lon"), before("lat"), "lon", "lat", a[0], a[1], b[0], b[1]), F.lit(False))).filter("crosses").drop("crosses")


def polygon_dwell(points: DataFrame, inside: DataFrame) -> DataFrame:
    """Intervals of consecutive steps with an end inside a polygon: ``polygon, mmsi, t_first, t_last, seconds``.

    ``inside`` has a row ``polygon, mmsi, event_id`` for every point in a polygon.  Only those points
    and their neighbours are looked at.
    """
    at = lambda name, by: F.lead(name, by).over(order()) if by > 0 else F.lag(name, -by).over(order())
    placed = points.select("mmsi", "event_id", "t", F.row_number().over(order()).alias("i"), at("t", -1).alias("t_before"), at("t", 1).alias("t_after"))
    hits = placed.join(inside, ["mmsi", "event_id"])
    steps = hits.select("polygon", "mmsi", F.explode(F.array(
        F.struct((F.col("i") - 1).alias("step"), F.col("t_before").alias("start"), F.col("t").alias("end")),
        F.struct(F.col("i").alias("step"), F.col("t").alias("start"), F.col("t_after").alias("end")),
    )).alias("s")).select("polygon", "mmsi", "s.*").filter("start is not null and end is not null").distinct()
    w = Window.partitionBy("polygon", "mmsi").orderBy("step")
    runs = steps.withColumn("run", F.col("step") - F.row_number().over(w)).groupBy("polygon", "mmsi", "run").agg(F.min("start").alias("t_first"), F.max("end").alias("t_last"))
    return runs.select("polygon", "mmsi", "t_first", "t_last", (F.col("t_last") - F.col("t_first")).alias("seconds"))


def bin_means(rows: DataFrame, keys: list[str], axis: Column, width: int) -> DataFrame:
    """Mean position and number of points per bin of ``axis``."""
    return rows.groupBy(*keys, F.floor(axis / width).cast("long").alias("bin")).agg(F.sum("lon").alias("sum_lon"), F.sum("lat").alias("sum_lat"), F.count(F.lit(1)).alias("n"))


def smoothed(bins: DataFrame, keys: list[str], reach: int = 2) -> DataFrame:
    """Centred means over bins up to ``reach`` away, weighted by their points."""
    w = Window.partitionBy(*keys).orderBy("bin").rangeBetween(-reach, reach)
    return bins.select(*keys, "bin", (F.sum("sum_lon").over(w) / F.sum("n").over(w)).alias("lon"), (F.sum("sum_lat").over(w) / F.sum("n").over(w)).alias("lat"), F.sum("n").over(w).alias("n"))


def gate_pairs(visits: DataFrame, first: str, second: str) -> DataFrame:
    """Ships whose visits to gates are to ``first`` in the first half and ``second`` in the second half, and to no other."""
    half = F.ntile(2).over(order())
    v = visits.withColumn("half", half)
    flags = v.groupBy("mmsi").agg(
        F.bool_or((F.col("half") == 1) & (F.col("gate") == first)).alias("a"),
        F.bool_or((F.col("half") == 2) & (F.col("gate") == second)).alias("b"),
        F.bool_or(~F.col("gate").isin(first, second)).alias("other"),
    )
    return flags.filter("a and b and not other").select("mmsi")


def greedy_capture(hits: DataFrame, seconds: int = 5400, longest: int = LONGEST) -> DataFrame:
    """Windows of ``seconds`` to both sides of a hit that do not overlap: the next window opens at the first hit beyond the last.

    A hit that comes two such spans after the one before opens a window whatever happened before; where a ship has more than
    ``longest`` hits, ships are cut there and scanned by several tasks.
    """

    def capture(batches):
        ship, end = None, None
        for batch in batches:
            rows = []
            for mmsi, home, t in zip(*(batch.column(c).to_pylist() for c in ("mmsi", "home", "t")), strict=True):
                if end is None or (mmsi, home) != ship or t - seconds > end:
                    ship, end = (mmsi, home), t + seconds
                    rows.append((mmsi, t - seconds, end))
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in (zip(*rows, strict=True) if rows else ((), (), ()))], ["mmsi", "t_from", "t_to"])

    rows, keys = hits.select("mmsi", "t"), ["mmsi", "home"]
    if any_longer(rows, "mmsi", longest):
        rows = homed(rows, ["mmsi"], "t", ["t"], lambda before: F.col("t") - before("t") > 2 * seconds, SLICE_S)
    else:
        rows, keys = rows.withColumn("home", F.lit(0)), ["mmsi"]
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "t")
    return ordered.mapInArrow(capture, "mmsi long, t_from long, t_to long")
