import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewake.functions.geo import haversine
from tidewake.operators import compress, stops
from tidewake.operators.stops import MAX_DIAGONAL_MM, MAX_SPEED_MM_S, _Fold, _pair_km


def scan(p):
    """The specification as a plain loop: (first, last) of each stop."""
    out, start, n = [], 0, len(p)

    def diagonal(box):
        return haversine(box[0], box[2], box[1], box[3]) * 1e6

    while start < n - 1:
        end, box = start, (p[start][1], p[start][1], p[start][2], p[start][2])
        while end < n - 1:
            t, x, y = p[end + 1]
            slow = haversine(*p[end][1:], x, y) * 1e6 / max(t - p[end][0], 1) <= MAX_SPEED_MM_S
            grown = (min(box[0], x), max(box[1], x), min(box[2], y), max(box[3], y))
            if slow and diagonal(grown) <= MAX_DIAGONAL_MM:
                box, end = grown, end + 1
                if end == n - 1:
                    out.append((start, end))
                    start = end
                    break
            else:
                if end > start:
                    out.append((start, end))
                    start = end
                else:
                    start = end + 1
                break
    return out


def folded(p):
    fold, members = _Fold(MAX_SPEED_MM_S, MAX_DIAGONAL_MM), {}
    km = [None, *_pair_km(np.array([q[1] for q in p]), np.array([q[2] for q in p])).tolist()]
    for i, (t, x, y) in enumerate(p):
        for stop in fold.feed(t, x, y, km[i]):
            members.setdefault(stop, []).append(i - 1)
    for stop in fold.end():
        members.setdefault(stop, []).append(len(p) - 1)
    assert all(m == list(range(m[0], m[-1] + 1)) for m in members.values())
    return [(m[0], m[-1]) for m in members.values()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=30))
def test_fold_equals_the_plain_scan(steps):
    t, p = 0, []
    for dt, x, y in steps:
        t += dt * 30
        p.append((t, 121 + x * 1e-4, 30 + y * 1e-4))
    assert folded(p) == scan(p)


def test_edges_of_detection(spark):
    rows = [(1, i, i * 3600, 121.0, 30.0) for i in range(5)] + [(2, 9, 0, 121.0, 30.0)] + [(3, 10, 0, 121.0, 30.0), (3, 11, 0, 121.0, 30.0)]
    df = spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double")
    got = {r["mmsi"]: r["point_num"] for r in stops.summarised(stops.stop_members(df)).collect()}
    assert got == {1: 5, 3: 2}
    assert stops.stop_members(df.limit(0)).count() == 0


def test_members_survive_small_batches(spark):
    rows = [(m, m * 1000 + i, i * 600, 121.0 + (i // 7) * 0.05, 30.0) for m in range(6) for i in range(40)]
    df = spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double")
    whole = sorted(map(tuple, stops.stop_members(df).select("mmsi", "event_id", "stop").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, stops.stop_members(df).select("mmsi", "event_id", "stop").collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("method", ["dp", "ddp", "qdp"])
def test_compression_keeps_ends_and_corners(spark, method):
    t = np.arange(201) * 60
    lon = 121 + np.minimum(np.arange(201), 100) * 1e-3
    lat = 30 + np.maximum(np.arange(201) - 100, 0) * 1e-3
    keep = compress.kept(t, lon, lat, 50.0, method)
    assert keep[0] and keep[-1] and keep[100] and keep.sum() <= 12
    assert compress.kept(t[:2], lon[:2], lat[:2], 50.0, method).all()
    df = spark.createDataFrame([(1, i, int(t[i]), float(lon[i]), float(lat[i]), 5.0) for i in range(201)], "mmsi long, event_id long, t long, lon double, lat double, sog double")
    out = {r["event_id"] for r in compress.compressed(df, 50.0, method, None, span_s=10**9).collect()}
    assert out == set(np.flatnonzero(keep).tolist())
