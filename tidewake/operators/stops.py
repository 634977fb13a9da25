"""Stop detection: greedy windows over the positions of a ship, with and without merging.

The windows are a fold over pairs of consecutive points with a state of a few numbers.  Points are
dealt by ship and sorted once, and each task streams through its ships; no trajectory is ever held as
a whole, however long it is.  A fast step ends any stop and starts the fold afresh: ships of very many points are cut at such
steps, the stretches are folded by tasks of their own, and running sums number the stops.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.geo import EARTH_KM, haversine, haversine_km
from tidewake.operators.slices import any_longer, homed
from tidewake.operators.trajectory import LONGEST, SLICE_S

MAX_SPEED_MM_S = 100.0
MAX_DIAGONAL_MM = 282842.712474619


def _pair_km(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """Distances of consecutive points, rounded as the column expression rounds them."""
    p = np.radians(lat)
    a = np.sin(np.diff(p) / 2) ** 2 + np.cos(p[:-1]) * np.cos(p[1:]) * np.sin(np.diff(np.radians(lon)) / 2) ** 2
    return np.rint(2 * np.arcsin(np.sqrt(a)) * EARTH_KM * 1e8) / 1e8


class _Fold:
    """The greedy scan of one ship; ``feed`` returns the stop numbers that the point before belongs to once they are known."""

    def __init__(self, max_speed: float, max_diagonal: float):
        self.max_speed, self.max_diagonal, self.stop = max_speed, max_diagonal, 0
        self.last = None

    def feed(self, t: int, lon: float, lat: float, km: float | None) -> list[int]:
        """Take the next point; the stops of the point before it, in order."""
        out: list[int] = []
        if self.last is None:
            self.open, self.box = False, (lon, lon, lat, lat)
        else:
            t0, lon0, lat0 = self.last
            slow = km * 1e6 / max(t - t0, 1) <= self.max_speed
            west, east, south, north = self.box
            grown = (min(west, lon), max(east, lon), min(south, lat), max(north, lat))
            if slow and self._diagonal(grown) <= self.max_diagonal:
                out, self.open, self.box = [self.stop], True, grown
            else:
                if self.open:
                    out = [self.stop]
                    self.stop += 1
                pair = (min(lon0, lon), max(lon0, lon), min(lat0, lat), max(lat0, lat))
                if self.open and slow and self._diagonal(pair) <= self.max_diagonal:
                    out, self.box = [*out, self.stop], pair
                else:
                    self.open, self.box = False, (lon, lon, lat, lat)
        self.last = (t, lon, lat)
        return out

    def end(self) -> list[int]:
        return [self.stop] if self.open else []

    @staticmethod
    def _diagonal(box: tuple) -> float:
        west, east, south, north = box
        return haversine(west, south, east, north) * 1e6


def _kernel(max_speed: float, max_diagonal: float, columns: list[str], keys: tuple[str, ...] = ("mmsi",)):
    """Rows sorted by ship and time in; each row once for every stop that holds it out, with ``stop`` its number."""

    def run(batches):
        ship, fold, before = None, None, None

        def rows(table: pa.RecordBatch, at: list[int], stops: list[int]) -> pa.RecordBatch:
            taken = table.take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays([*taken.columns, pa.array(stops, pa.int64())], [*columns, "stop"])

        for batch in batches:
            table = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
            ships, t = list(zip(*(table.column(k).to_pylist() for k in keys), strict=True)), table.column("t").to_pylist()
            lon, lat = (table.column(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat"))
            km = [None, *_pair_km(lon, lat).tolist()]
            lon, lat = lon.tolist(), lat.tolist()
            at, stops = [], []
            for i in range(0 if before is None else 1, len(ships)):
                if fold is None or ships[i] != ship:
                    found = fold.end() if fold is not None else []
                    fold, ship = _Fold(max_speed, max_diagonal), ships[i]
                    at += [i - 1] * len(found)
                    stops += found
                found = fold.feed(t[i], lon[i], lat[i], km[i])
                at += [i - 1] * len(found)
                stops += found
            before = table.slice(len(ships) - 1, 1)
            if at:
                yield rows(table, at, stops)
        if fold is not None and fold.end():
            yield rows(before, [0], fold.end())

    return run


def stop_members(points: DataFrame, max_speed_mm_s: float = MAX_SPEED_MM_S, max_diagonal_mm: float = MAX_DIAGONAL_MM, longest: int = LONGEST, slice_s: int = SLICE_S) -> DataFrame:
    """The points of every stop with its number within the ship; a point on the edge of two stops comes twice."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    if not any_longer(points, "mmsi", longest):
        ordered = points.repartition("mmsi").sortWithinPartitions("mmsi", "t", "event_id")
        return ordered.mapInArrow(_kernel(max_speed_mm_s, max_diagonal_mm, points.columns), f"{fields}, stop long")

    def fast(before):
        km = haversine_km(before("lon"), before("lat"), "lon", "lat")
        return km * 1e6 / F.greatest(F.col("t") - before("t"), F.lit(1)) > max_speed_mm_s

    keys = ("mmsi", "home")
    stretches = homed(points, ["mmsi"], "t", ["t", "event_id"], fast, slice_s).repartition(*keys).sortWithinPartitions(*keys, "t", "event_id")
    found = stretches.mapInArrow(_kernel(max_speed_mm_s, max_diagonal_mm, [*points.columns, "home"], keys), f"{fields}, home long, stop long")
    held = found.groupBy(*keys).agg((F.max("stop") + 1).alias("n"))
    before = held.select(*keys, F.coalesce(F.sum("n").over(Window.partitionBy("mmsi").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    before = before.withColumnsRenamed({"mmsi": "of", "home": "of_home"})
    same = F.col("mmsi").eqNullSafe(F.col("of")) & F.col("home").eqNullSafe(F.col("of_home"))
    return found.join(before, same).select(*points.columns, (F.col("stop") + F.col("before")).alias("stop"))


def summarised(members: DataFrame, *first: str) -> DataFrame:
    """One row a stop: its ends, centre and number of points, and the columns ``first`` of its first point."""
    ends = F.struct("t", "event_id", "lon", "lat", *first)
    s = members.groupBy("mmsi", "stop").agg(F.min(ends).alias("first"), F.max(ends).alias("last"), F.count(F.lit(1)).alias("point_num"), F.avg("lon").alias("lon"), F.avg("lat").alias("lat"))
    return s.select(
        "mmsi", "stop", F.col("first.t").alias("begin_t"), F.col("last.t").alias("end_t"),
        F.col("first.lon").alias("begin_lon"), F.col("first.lat").alias("begin_lat"), F.col("last.lon").alias("end_lon"), F.col("last.lat").alias("end_lat"),
        "point_num", "lon", "lat", *[F.col(f"first.{c}").alias(c) for c in first],
    )


def merged_numbers(stops: DataFrame, merge_km: float = 0.1, merge_s: int = 1800) -> DataFrame:
    """``stops`` with ``merged``: neighbours of one ship share it when the gap between them is short in space or in time."""
    w = Window.partitionBy("mmsi").orderBy("stop")
    before = lambda name: F.lag(name).over(w)
    near = haversine_km(before("end_lon"), before("end_lat"), "begin_lon", "begin_lat") <= merge_km
    soon = F.col("begin_t") - before("end_t") <= merge_s
    starts = F.when(F.coalesce(near | soon, F.lit(False)), 0).otherwise(1)
    return stops.withColumn("merged", F.sum(starts).over(w))


def merged_stops(stops: DataFrame, merge_km: float = 0.1, merge_s: int = 1800) -> DataFrame:
    """Merged stops: begin of the first, end of the last, points added up."""
    m = merged_numbers(stops, merge_km, merge_s)
    return m.groupBy("mmsi", "merged").agg(F.min("begin_t").alias("begin_t"), F.max("end_t").alias("end_t"), F.sum("point_num").alias("point_num"), F.count(F.lit(1)).alias("n_stops"))


def stop_statistics(members: DataFrame) -> DataFrame:
    """Means, population variances and extremes of heading, course and speed per stop, and the time since the stop before."""
    top = F.struct("sog", (-F.col("t")).alias("a"), (-F.col("event_id")).alias("b"), "cog")
    last = F.struct("t", "event_id", "draught", "status")
    s = members.groupBy("mmsi", "stop").agg(
        F.min("t").alias("begin_t"), F.max("t").alias("end_t"), F.count(F.lit(1)).alias("point_num"),
        F.avg("sog").alias("avg_sog"), F.var_pop("sog").alias("var_sog"), F.max("sog").alias("max_sog"), F.max(top).alias("top"),
        F.var_pop("head").alias("var_hdg"), F.var_pop("cog").alias("var_cog"), F.avg(F.col("head") - F.col("cog")).alias("avg_hdg_cog"),
        F.countDistinct("draught").alias("draughts"), F.max(last).alias("last"),
    )
    w = Window.partitionBy("mmsi").orderBy("stop")
    return s.select(
        "mmsi", "stop", "begin_t", "end_t", "point_num", (F.col("begin_t") - F.lag("end_t").over(w)).alias("apart_s"),
        "avg_sog", "var_sog", "max_sog", F.col("top.cog").alias("max_sog_cog"), "var_hdg", "var_cog", "avg_hdg_cog",
        F.when(F.col("draughts") == 2, F.col("last.draught")).alias("draught"), F.col("last.status").alias("navistate"),
    )
