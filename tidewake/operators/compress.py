"""Trajectory compression: Douglas-Peucker by height, by time-weighted height, by changes of state and by projection.

Tracks are dealt by ship, sorted once, and cut where the speed crosses a threshold, or at spans of time; each cut piece is
compressed with an explicit stack.  The ends of every piece stay.  A piece is held by one task, up to
``LONGEST`` points: longer ones are split before at the point where the method splits them first, and so on until all are
short.  For ``dp`` and ``ddp`` that point is the highest one; for ``sdp`` and ``qdp`` it is the highest of those at which the
track turns, which a window over the part tells from the points beside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.geo import EARTH_KM, KM_PER_DEGREE, haversine_km
from tidewake.operators.trajectory import speed_cut
from tidewake.sources.tables import checkpointed

METHODS = ("dp", "ddp", "sdp", "qdp")
LONGEST = 1 << 20
# Least speeds in millimetres a second and kilometres a second.
LEAST_MM_S, LEAST_KM_S = 100.0, 0.0001


def _km(lon1, lat1, lon2, lat2) -> np.ndarray:
    a = np.sin((lat1 - lat2) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon1 - lon2) / 2) ** 2
    return 2 * np.arcsin(np.sqrt(a)) * EARTH_KM


def _height(a: np.ndarray, b: np.ndarray, base: float) -> np.ndarray:
    """Height of triangles over ``base`` by their sides; the side itself over a base of nothing."""
    if base == 0:
        return a
    s = (a + b + base) / 2
    return 2 * np.sqrt(np.maximum(s * (s - a) * (s - b) * (s - base), 0)) / base


def _split(keep: np.ndarray, farthest) -> np.ndarray:
    stack = [(0, len(keep) - 1)]
    while stack:
        low, high = stack.pop()
        if high - low < 2:
            continue
        at = farthest(low, high)
        if at is not None:
            keep[at] = True
            stack += [(low, at), (at, high)]
    return keep


def _turning(t, lon, lat, low: int, high: int) -> tuple[int, float]:
    """The highest inner point at which the track turns from going away to coming back, or the reverse, and its height in millimetres.

    Space and time make three dimensions, the time weighted by the mean speed.
    """
    piece = slice(low, high + 1)
    t, x, y = (t[piece] - t[low]).astype(float), lon[piece] - lon[low], lat[piece] - lat[low]
    a, b = np.radians(lon[piece]), np.radians(lat[piece])
    mm = lambda i: _km(a, b, a[i], b[i]) * 1e6
    from_first, to_last = mm(0), mm(-1)
    weight = max(from_first[-1] / max(t[-1], 1), LEAST_MM_S)
    track = np.stack([x * np.cos(np.radians((lat[low] + lat[high]) / 2)), y, t * weight], 1)
    gone, ahead = np.cross(track[1:-1], track[-1]), np.cross(np.diff(track, axis=0)[1:], track[-1])
    sign = np.sign((gone * ahead).sum(axis=1))
    moved = np.flatnonzero(sign)
    turns = moved[np.diff(sign[moved], prepend=1) != 0]
    if not len(turns):
        return -1, 0.0
    inner = turns + 1
    base = float(np.hypot(from_first[-1], t[-1] * weight))
    heights = _height(np.hypot(from_first[inner], t[inner] * weight), np.hypot(to_last[inner], (t[-1] - t[inner]) * weight), base)
    best = int(heights.argmax())
    return low + int(inner[best]), float(heights[best])


def _standing(t, lon, lat, low: int, high: int, limit: float) -> int | None:
    """The inner point farthest from the line of the ends among those whose projection is a turning point, if beyond ``limit`` kilometres.

    Points are projected along the line of the ends in space and weighted time; what counts is their distance from it.
    """
    piece = slice(low, high + 1)
    scale = np.cos(np.radians((lat[low] + lat[high]) / 2))
    seconds = float(max(t[high] - t[low], 1))
    weight = max(float(np.hypot((lon[high] - lon[low]) * scale, lat[high] - lat[low])) / seconds, LEAST_KM_S / KM_PER_DEGREE)
    line = np.array([lon[high] - lon[low], lat[high] - lat[low], seconds * weight])
    track = np.stack([(lon[piece] - lon[low]) * scale, lat[piece] - lat[low], (t[piece] - t[low]) * weight], 1)
    seen = np.cross(track, line)
    steps = np.diff(seen, axis=0)
    back = -steps[:-1]
    back[0] = 0
    inner = seen[1:-1]
    turns = ((back * inner).sum(axis=1) <= 0) & ((steps[1:] * inner).sum(axis=1) < 0)
    far = np.where(turns, (inner * inner).sum(axis=1), 0.0)
    at = int(far.argmax())
    return low + 1 + at if far[at] > (limit / KM_PER_DEGREE * line[2]) ** 2 else None


def kept(t: np.ndarray, lon: np.ndarray, lat: np.ndarray, metres: float, method: str) -> np.ndarray:
    """Which points of one piece stay: ``dp``, ``ddp`` (time-weighted), ``sdp`` (changes of state) or ``qdp`` (projection)."""
    if method not in METHODS:
        raise ValueError(f"method has to be one of {METHODS}")
    keep = np.zeros(len(t), bool)
    keep[[0, -1]] = True
    limit = metres / 1000
    if method == "qdp":
        return _split(keep, lambda low, high: _standing(t, lon, lat, low, high, limit))
    if method == "sdp":

        def turning(low: int, high: int):
            at, height = _turning(t, lon, lat, low, high)
            return at if height > limit * 1e6 else None

        return _split(keep, turning)
    x, y = np.radians(lon), np.radians(lat)

    def high(low: int, top: int):
        inner = slice(low + 1, top)
        a, b = _km(x[low], y[low], x[inner], y[inner]), _km(x[inner], y[inner], x[top], y[top])
        base = float(_km(x[low], y[low], x[top], y[top]))
        if method == "ddp":
            weight = base / max(t[top] - t[low], 1)
            a, b = np.hypot(a, (t[inner] - t[low]) * weight), np.hypot(b, (t[top] - t[inner]) * weight)
            base = float(np.hypot(base, (t[top] - t[low]) * weight))
        h = _height(a, b, base)
        at = int(h.argmax())
        return low + 1 + at if h[at] > limit else None

    return _split(keep, high)


_PIECE = ("mmsi", "span", "segment")
_PART = (*_PIECE, "low_t", "low_id")


def _heights(method: str) -> Column:
    """The height in kilometres of a point over the line from ``a`` to ``b``."""
    from_a, to_b, base = (haversine_km(f"{x}lon", f"{x}lat", f"{y}lon", f"{y}lat") for x, y in (("a.", ""), ("", "b."), ("a.", "b.")))
    if method == "ddp":
        weight = base / F.greatest(F.col("b.t") - F.col("a.t"), F.lit(1))
        longer = lambda km, s: F.hypot(km, s * weight)
        from_a, to_b, base = longer(from_a, F.col("t") - F.col("a.t")), longer(to_b, F.col("b.t") - F.col("t")), longer(base, F.col("b.t") - F.col("a.t"))
    s = (from_a + to_b + base) / 2
    area = F.sqrt(F.greatest(s * (s - from_a) * (s - to_b) * (s - base), F.lit(0.0)))
    return F.when(base > 0, 2 * area / base).otherwise(from_a)


def _km_between(lon1: str, lat1: str, lon2: str, lat2: str) -> Column:
    """Great-circle distance, not rounded, as the kernels have it."""
    x1, y1, x2, y2 = (F.radians(F.col(name)) for name in (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin((y1 - y2) / 2), 2) + F.cos(y1) * F.cos(y2) * F.pow(F.sin((x1 - x2) / 2), 2)
    return 2 * F.asin(F.sqrt(a)) * EARTH_KM


def _cross(u: tuple, v: tuple) -> tuple:
    return u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]


def _dot(u: tuple, v: tuple) -> Column:
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def _standing_heights(met: DataFrame, metres: float) -> DataFrame:
    """``met`` with ``h``, over 1 where a point stands beyond the limit at a turn of its projection."""
    w = Window.partitionBy(*_PART).orderBy("t", "event_id")
    scale = F.cos(F.radians((F.col("a.lat") + F.col("b.lat")) / 2))
    seconds = F.greatest(F.col("b.t") - F.col("a.t"), F.lit(1)).cast("double")
    far_x, far_y = F.col("b.lon") - F.col("a.lon"), F.col("b.lat") - F.col("a.lat")
    met = met.withColumn("weight", F.greatest(F.hypot(far_x * scale, far_y) / seconds, F.lit(LEAST_KM_S / KM_PER_DEGREE)))
    line = (far_x, far_y, seconds * F.col("weight"))
    track = ((F.col("lon") - F.col("a.lon")) * scale, F.col("lat") - F.col("a.lat"), (F.col("t") - F.col("a.t")) * F.col("weight"))
    met = met.withColumns({f"seen{i}": part for i, part in enumerate(_cross(track, line))}).withColumn("reach", line[2])
    seen = tuple(F.col(f"seen{i}") for i in range(3))
    met = met.withColumns({**{f"back{i}": F.lag(seen[i]).over(w) for i in range(3)}, **{f"next{i}": F.lead(seen[i]).over(w) for i in range(3)}, "place": F.row_number().over(w)})
    back = tuple(-(seen[i] - F.col(f"back{i}")) for i in range(3))
    ahead = tuple(F.col(f"next{i}") - seen[i] for i in range(3))
    # The first inner point has nothing to come back from.
    turns = ((F.col("place") == 2) | (_dot(back, seen) <= 0)) & (_dot(ahead, seen) < 0)
    height = _dot(seen, seen) / F.pow(F.lit(metres / 1000 / KM_PER_DEGREE) * F.col("reach"), F.lit(2))
    out = met.withColumn("h", F.when(turns, height).otherwise(0.0))
    return out.drop("weight", "reach", "place", *[f"{x}{i}" for x in ("seen", "back", "next") for i in range(3)])


def _turning_heights(met: DataFrame, metres: float) -> DataFrame:
    """``met`` with ``h``, over 1 where a point is beyond the limit at a change between going away and coming back."""
    w = Window.partitionBy(*_PART).orderBy("t", "event_id")
    scale = F.cos(F.radians((F.col("a.lat") + F.col("b.lat")) / 2))
    whole = F.col("b.t") - F.col("a.t")
    met = met.withColumn("base_mm", _km_between("a.lon", "a.lat", "b.lon", "b.lat") * 1e6)
    met = met.withColumn("weight", F.greatest(F.col("base_mm") / F.greatest(whole, F.lit(1)), F.lit(LEAST_MM_S)))
    weight = F.col("weight")
    line = ((F.col("b.lon") - F.col("a.lon")) * scale, F.col("b.lat") - F.col("a.lat"), whole * weight)
    track = ((F.col("lon") - F.col("a.lon")) * scale, F.col("lat") - F.col("a.lat"), (F.col("t") - F.col("a.t")) * weight)
    met = met.withColumns({f"at{i}": part for i, part in enumerate(track)})
    at = tuple(F.col(f"at{i}") for i in range(3))
    met = met.withColumns({f"next{i}": F.lead(at[i]).over(w) for i in range(3)})
    ahead = tuple(F.col(f"next{i}") - at[i] for i in range(3))
    met = met.withColumn("sign", F.signum(_dot(_cross(at, line), _cross(ahead, line))))
    before = F.last(F.nullif(F.col("sign"), F.lit(0.0)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("before", F.coalesce(before, F.lit(1.0)))
    from_a = F.hypot(_km_between("a.lon", "a.lat", "lon", "lat") * 1e6, (F.col("t") - F.col("a.t")) * weight)
    to_b = F.hypot(_km_between("lon", "lat", "b.lon", "b.lat") * 1e6, (F.col("b.t") - F.col("t")) * weight)
    base = F.hypot(F.col("base_mm"), whole * weight)
    s = (from_a + to_b + base) / 2
    height = F.when(base > 0, 2 * F.sqrt(F.greatest(s * (s - from_a) * (s - to_b) * (s - base), F.lit(0.0))) / base).otherwise(from_a)
    turns = (F.col("sign") != 0) & (F.col("sign") != F.col("before"))
    out = met.withColumn("h", F.when(turns, height / (metres * 1000)).otherwise(0.0))
    return out.drop("base_mm", "weight", "sign", "before", *[f"{x}{i}" for x in ("at", "next") for i in range(3)])


def _scored(met: DataFrame, metres: float, method: str) -> DataFrame:
    """``met``, points with the ends ``a`` and ``b`` of their part, and ``h``: their height in limits where the method may split there."""
    if method == "qdp":
        return _standing_heights(met, metres)
    if method == "sdp":
        return _turning_heights(met, metres)
    return met.withColumn("h", _heights(method) / (metres / 1000))


def _parted(pieces: DataFrame, metres: float, method: str, longest: int) -> DataFrame:
    """``pieces`` in parts of ``longest`` points at most that no later step changes: ``low_t, low_id``, and ``again`` at the start of a later part."""
    whole = pieces.withColumns({"low_t": F.lit(-1 << 62), "low_id": F.lit(-1 << 62), "again": F.lit(False)})
    long = pieces.groupBy(*_PIECE).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > longest).drop("n")
    out, todo = whole.join(long, list(_PIECE), "left_anti"), checkpointed(whole.join(long, list(_PIECE), "left_semi"))
    place = F.struct("t", "event_id")
    while True:
        point = F.struct("t", "event_id", "lon", "lat")
        ends = todo.groupBy(*_PART).agg(F.min(point).alias("a"), F.max(point).alias("b"), F.count(F.lit(1)).alias("n"))
        out = out.unionByName(todo.join(ends.filter(F.col("n") <= longest).select(*_PART), list(_PART), "left_semi"))
        big = checkpointed(ends.filter(F.col("n") > longest).drop("n"))
        if big.isEmpty():
            return out
        met = todo.join(big, list(_PART))
        inner = _scored(met, metres, method).filter((place > F.struct("a.t", "a.event_id")) & (place < F.struct("b.t", "b.event_id")))
        best = inner.groupBy(*_PART).agg(F.max(F.struct("h", (-F.col("t")).alias("t"), (-F.col("event_id")).alias("id"))).alias("best"))
        met = met.join(best, list(_PART), "left")
        split = F.coalesce(F.col("best.h") > 1, F.lit(False))
        cut = F.struct((-F.col("best.t")).alias("t"), (-F.col("best.id")).alias("event_id"))
        columns = todo.columns
        flat = met.filter(~split & ((place == F.struct("a.t", "a.event_id")) | (place == F.struct("b.t", "b.event_id")))).select(*columns)
        out = out.unionByName(flat)
        left = met.filter(split & (place <= cut)).select(*columns)
        right = met.filter(split & (place >= cut)).withColumns({"low_t": cut["t"], "low_id": cut["event_id"], "again": place == cut}).select(*columns)
        todo = checkpointed(left.unionByName(right))


def _kernel(metres: float, method: str, columns: list[str], keys: tuple[str, ...]):
    """Rows sorted by piece and time in, those that stay out; a batch's pieces are compressed over its columns, of one or two points none."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def key_columns(batch: pa.RecordBatch) -> np.ndarray:
            return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys], 1)

        def pieces(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            by = key_columns(rows)
            edges = np.concatenate([[0], np.flatnonzero((by[1:] != by[:-1]).any(axis=1)) + 1, [len(by)]])
            t, lon, lat = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("t", "lon", "lat"))
            keep = np.ones(len(by), bool)
            for i in np.flatnonzero(np.diff(edges) > 2).tolist():
                a, b = edges[i], edges[i + 1]
                keep[a:b] = kept(t[a:b], lon[a:b], lat[a:b], metres, method)
            if "again" in rows.schema.names:
                keep &= ~rows.column("again").to_numpy(zero_copy_only=False)
            return rows.filter(pa.array(keep)).select(columns)

        for batch in (b for b in batches if b.num_rows):
            by = key_columns(batch)
            cuts = np.flatnonzero((by[1:] != by[:-1]).any(axis=1)) + 1
            if held and (by[0] != key_columns(held[0].slice(0, 1))[0]).any():
                cuts = np.concatenate([[0], cuts])
            if len(cuts):
                # The last piece of the batch may go on in the next one.
                done = [*held, *([batch.slice(0, cuts[-1])] if cuts[-1] else [])]
                if done:
                    yield pieces(done)
                held = [batch.slice(cuts[-1])]
            else:
                held.append(batch)
        if held:
            yield pieces(held)

    return run


def compressed(points: DataFrame, metres: float, method: str = "qdp", cut_mm_s: float | None = 300.0, span_s: int | None = None, longest: int = LONGEST, once: list[str] | None = None) -> DataFrame:
    """The rows of ``points`` that stay, pieces cut at speed crossings (or not, with ``cut_mm_s`` None) and at spans of time where ``span_s`` is given.

    Of kept rows that repeat the columns ``once`` a single one is given out, the least by all other columns.
    """
    if method not in METHODS:
        raise ValueError(f"method has to be one of {METHODS}")
    columns = points.columns
    cut = speed_cut(points, cut_mm_s) if cut_mm_s is not None else points.withColumn("segment", F.lit(0).cast("long"))
    span = F.expr(f"t div {span_s}") if span_s else F.lit(0).cast("long")
    keyed = cut.select(*columns, span.alias("span"), F.col("segment"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    if points.groupBy("mmsi").count().filter(F.col("count") > longest).isEmpty():
        # Where no ship is long no piece is, and the order in which the cuts were found is that of the pieces.
        dealt, keys = keyed if cut_mm_s is not None else keyed.repartition("mmsi"), _PIECE
        ordered = dealt.sortWithinPartitions("mmsi", "t", "event_id")
    else:
        dealt, keys = _parted(keyed, metres, method, longest).repartition(*_PART), _PART
        ordered = dealt.sortWithinPartitions(*_PART, "t", "event_id")
    out = ordered.mapInArrow(_kernel(metres, method, columns, keys), fields)
    if not once:
        return out
    rest = [c for c in columns if c not in once]
    single = out.groupBy(*once).agg(F.min(F.struct(*rest)).alias("kept")) if rest else out.select(*once).distinct()
    return single.select(*[F.col(c) if c in once else F.col(f"kept.{c}").alias(c) for c in columns])


def deviation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per ship, the share of the distance that compression loses; both have ``mmsi, distance_km``."""
    a, b = before.select("mmsi", F.col("distance_km").alias("full_km")), after.select("mmsi", F.col("distance_km").alias("kept_km"))
    return a.join(b, "mmsi").select("mmsi", F.when(F.col("full_km") > 0, 1 - F.col("kept_km") / F.col("full_km")).otherwise(0.0).alias("deviation"))
