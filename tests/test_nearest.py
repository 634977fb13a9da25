"""The ring search against all pairs, and its plan."""

import random

import pytest
from pyspark.sql import functions as F

from tidewake.functions.geo import haversine
from tidewake.operators import rules, spatial


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("spread", ["near", "globe", "seam", "poles"])
def test_nearest_of_all_pairs(spark, spread):
    rng = random.Random(spread)
    lon = {"near": lambda: rng.uniform(121, 123), "seam": lambda: rng.choice([-1, 1]) * rng.uniform(178, 180)}.get(spread, lambda: rng.uniform(-180, 180))
    lat = {"near": lambda: rng.uniform(29, 31), "poles": lambda: rng.choice([-1, 1]) * rng.uniform(80, 90)}.get(spread, lambda: rng.uniform(-60, 60))
    points = [(i, lon(), lat(), rng.randint(0, 3)) for i in range(120)] + [(200, 180.0, 90.0, 0), (201, -180.0, -90.0, 1), (202, None, 3.0, 1)]
    targets = [(i, lon(), lat(), rng.choice([0, 1, 1, 2])) for i in range(25)]
    p = spark.createDataFrame(points, "id long, lon double, lat double, kind int")
    t = spark.createDataFrame(targets, "target long, target_lon double, target_lat double, of int")
    out = {r["id"]: r["best"] for r in spatial.nearest_by_rings(p, t, ["target"], F.col("kind") != F.col("of")).collect()}
    assert set(out) == {x[0] for x in points} and out[202] is None
    for i, x, y, kind in points[:-1]:
        km, target = min((haversine(x, y, a, b), j) for j, a, b, of in targets if of != kind)
        # The two roundings of a distance may differ in the last place.
        assert abs(out[i]["km"] - km) < 1e-6 and (out[i]["target"] == target or spread == "poles")


def test_nobody_eligible_and_nothing_there(spark):
    p = spark.createDataFrame([(1, 121.0, 30.0)], "id long, lon double, lat double")
    t = spark.createDataFrame([(1, 121.0, 30.0)], "target long, target_lon double, target_lat double")
    assert [r["best"] for r in spatial.nearest_by_rings(p, t, ["target"], F.lit(False)).collect()] == [None]
    assert spatial.nearest_by_rings(p.limit(0), t, ["target"]).collect() == []
    assert [r["best"] for r in spatial.nearest_by_rings(p, t.limit(0), ["target"]).collect()] == [None]


def test_no_join_without_an_equality(spark, monkeypatch):
    plans = []
    kept = spatial.checkpointed
    monkeypatch.setattr(spatial, "checkpointed", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df))
    latest = spark.createDataFrame([(i, 121.0 + i, 30.0, 90) for i in range(20)], "mmsi long, lon double, lat double, cog long")
    channel = spark.createDataFrame([(i, 118.0 + 3 * i, 31.0, 45 * i % 360) for i in range(20)], "channel_id long, c_lon double, c_lat double, c_cog long")
    assert rules.nearest_channel_point(latest, channel).count() == 20
    assert len(plans) > 2 and not any("NestedLoop" in x or "Cartesian" in x for x in plans)
