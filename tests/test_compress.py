"""Compression against recursive readings of each method on random tracks."""

import math

import numpy as np
import pytest

from tidewake.operators import compress

EARTH = 6378.137


def _km(p, q):
    x1, y1, x2, y2 = map(math.radians, (p[1], p[2], q[1], q[2]))
    return 2 * EARTH * math.asin(math.sqrt(math.sin((y1 - y2) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x1 - x2) / 2) ** 2))


def _height(a, b, base):
    s = (a + b + base) / 2
    return 2 * math.sqrt(max(s * (s - a) * (s - b) * (s - base), 0)) / base if base else a


def _cross(u, v):
    return (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])


def _dot(u, v):
    return sum(a * b for a, b in zip(u, v, strict=True))


def _minus(u, v):
    return tuple(a - b for a, b in zip(u, v, strict=True))


def _farthest_dp(p, weighted):
    first, last = p[0], p[-1]
    flat = _km(first, last)
    w = flat / max(last[0] - first[0], 1) if weighted else 0.0
    far = lambda a, b: math.hypot(_km(a, b), w * (b[0] - a[0]))
    base = far(first, last)
    return max(((_height(far(first, q), far(q, last), base), -i) for i, q in enumerate(p[1:-1], 1)), default=(0, 0))


def _farthest_state(p):
    first, last = p[0], p[-1]
    w = max(_km(first, last) * 1e6 / max(last[0] - first[0], 1), 100.0)
    scale = math.cos(math.radians((first[2] + last[2]) / 2))
    vector = lambda a, b: ((b[1] - a[1]) * scale, b[2] - a[2], (b[0] - a[0]) * w)
    far = lambda a, b: math.hypot(_km(a, b) * 1e6, w * (b[0] - a[0]))
    line, state, best = vector(first, last), 1, (0.0, 0)
    for i in range(1, len(p) - 1):
        now = _dot(_cross(vector(first, p[i]), line), _cross(vector(p[i], p[i + 1]), line))
        if now * state < 0:
            state = -state
            best = max(best, (_height(far(first, p[i]), far(p[i], last), far(first, last)), -i))
    return best[0] / 1e6, best[1]


def _farthest_projection(p):
    first, last = p[0], p[-1]
    scale = math.cos(math.radians((first[2] + last[2]) / 2))
    seconds = max(last[0] - first[0], 1)
    w = max(math.hypot((last[1] - first[1]) * scale, last[2] - first[2]) / seconds, 0.0001 / compress.KM_PER_DEGREE)
    line = (last[1] - first[1], last[2] - first[2], seconds * w)
    seen = [_cross(((q[1] - first[1]) * scale, q[2] - first[2], (q[0] - first[0]) * w), line) for q in p]
    best, back = (0.0, 0), (0, 0, 0)
    for i in range(1, len(p) - 1):
        ahead = _minus(seen[i + 1], seen[i])
        if _dot(back, seen[i]) <= 0 and _dot(ahead, seen[i]) < 0:
            best = max(best, (_dot(seen[i], seen[i]), -i))
        back = tuple(-x for x in ahead)
    return math.sqrt(best[0]) / line[2] * compress.KM_PER_DEGREE, best[1]


FARTHEST = {"dp": lambda p: _farthest_dp(p, False), "ddp": lambda p: _farthest_dp(p, True), "sdp": _farthest_state, "qdp": _farthest_projection}


def _recursive(p, limit, farthest):
    if len(p) < 3:
        return list(p)
    height, at = farthest(p)
    if height <= limit:
        return [p[0], p[-1]]
    return _recursive(p[: 1 - at], limit, farthest)[:-1] + _recursive(p[-at:], limit, farthest)


@pytest.mark.parametrize("method", compress.METHODS)
@pytest.mark.parametrize("metres", [20.0, 100.0, 500.0])
def test_random_tracks(method, metres):
    rng = np.random.default_rng(int(metres))
    for n in (1, 2, 3, 10, 60, 150):
        for _ in range(5):
            t = np.cumsum(rng.integers(0, 90, n)) + 1_700_000_000
            course = np.cumsum(rng.normal(0, 0.5, n))
            lon, lat = 121 + np.cumsum(np.cos(course)) * 0.002, 30 + np.cumsum(np.sin(course)) * 0.002
            points = list(zip(t.tolist(), lon.tolist(), lat.tolist(), strict=True))
            keep = compress.kept(t, lon, lat, metres, method)
            assert [p for p, k in zip(points, keep, strict=True) if k] == _recursive(points, metres / 1000, FARTHEST[method])


def test_a_ship_at_rest_keeps_its_ends():
    for method in compress.METHODS:
        keep = compress.kept(np.arange(50) * 60, np.full(50, 121.0), np.full(50, 30.0), 50.0, method)
        assert keep.sum() == 2 and keep[0] and keep[-1]


def test_unknown_methods_and_spans(spark):
    with pytest.raises(ValueError, match="method"):
        compress.kept(np.arange(3), np.zeros(3), np.zeros(3), 1.0, "xdp")
    rows = [(1, i, 86_400 * i, 121.0, 30.0, 1.0) for i in range(10)]
    p = spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double, sog double")
    assert compress.compressed(p, 50.0, "dp", None).count() == 2
    assert compress.compressed(p, 50.0, "dp", None, span_s=3 * 86_400).count() == 7


@pytest.mark.parametrize("method", compress.METHODS)
def test_long_pieces_are_split_where_the_method_does(spark, method):
    rng = np.random.default_rng(9)
    rows = []
    for ship, n in ((1, 400), (2, 30), (3, 1)):
        course = np.cumsum(rng.normal(0, 0.5, n))
        lon, lat = 121 + np.cumsum(np.cos(course)) * 0.002, 30 + np.cumsum(np.sin(course)) * 0.002
        rows += [(ship, 1000 * ship + i, 60 * i, x, y, 1.0) for i, (x, y) in enumerate(zip(lon.tolist(), lat.tolist(), strict=True))]
    rows += [(4, 5000 + i, 60 * i, 121.0, 30.0, 0.0) for i in range(100)]
    p = spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double, sog double").repartition(3)
    whole = sorted(r["event_id"] for r in compress.compressed(p, 300.0, method, None).collect())
    parted = sorted(r["event_id"] for r in compress.compressed(p, 300.0, method, None, longest=40).collect())
    assert parted == whole and 20 < len(whole) < 300
    # Cut at spans of time as well, and in batches that split pieces.
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "7")
    try:
        small = [sorted(r["event_id"] for r in compress.compressed(p, 300.0, method, None, span_s=3000, longest=n).collect()) for n in (compress.LONGEST, 25)]
    finally:
        spark.conf.set(batch, before)
    assert small[0] == small[1] and len(small[0]) > len(whole)
