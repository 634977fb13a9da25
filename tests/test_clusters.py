"""Density clusters against all pairs."""

import random

import pytest

from tidewake.functions.geo import haversine
from tidewake.operators import clusters


def brute(points, eps, least):
    known = [(i, x, y) for i, x, y in points if x is not None]
    near = {i: [(haversine(x, y, a, b), j) for j, a, b in known if haversine(x, y, a, b) <= eps] for i, x, y in known}
    core = {i for i, found in near.items() if len(found) >= least}
    name = {}
    for i in sorted(core):
        todo = [i] if i not in name else []
        while todo:
            j = todo.pop()
            if j not in name:
                name[j] = i
                todo += [k for _, k in near[j] if k in core]
    out = {}
    for i, *_ in points:
        reach = [(km, name[j]) for km, j in near.get(i, []) if j in core]
        out[i] = ("core", name[i]) if i in core else ("border", min(reach)[1]) if reach else ("noise", None)
    return out


def _points(kind, rng):
    if kind == "uniform":
        return [(i, rng.uniform(121, 122), rng.uniform(30, 31)) for i in range(300)]
    if kind == "dense":
        # Most points in one cell, others in a thin line to it and beyond.
        spot = [(i, 121.5 + rng.gauss(0, 0.004), 30.5 + rng.gauss(0, 0.004)) for i in range(400)]
        line = [(1000 + i, 121.5 + 0.02 * i, 30.5 + rng.uniform(-0.004, 0.004)) for i in range(40)]
        return spot + line + [(2000 + i, 121.5, 30.5) for i in range(30)]
    if kind == "seam":
        return [(i, (180 + rng.uniform(-0.3, 0.3) + 180) % 360 - 180, rng.uniform(-0.5, 0.5)) for i in range(200)]
    return [(i, rng.uniform(10, 14), rng.choice([-1, 1]) * rng.uniform(84, 86)) for i in range(300)] + [(999, None, 30.0)]


@pytest.mark.parametrize("kind,eps,least", [("uniform", 5.0, 5), ("uniform", 12.0, 3), ("dense", 2.0, 4), ("dense", 0.7, 12), ("seam", 6.0, 4), ("north", 7.0, 4)])
def test_clusters_of_all_pairs(spark, kind, eps, least):
    points = _points(kind, random.Random(kind))
    got = clusters.density_clusters(spark.createDataFrame(points, "id long, lon double, lat double").repartition(3), eps, least)
    out = {r["id"]: (r["kind"], r["cluster"]) for r in got.collect()}
    want = brute(points, eps, least)
    assert out == want and "core" in {k for k, _ in want.values()}


def test_a_long_chain_and_nothing(spark):
    chain = [(500 - i, 121.0 + 0.01 * i, 30.0) for i in range(120)]
    table = spark.createDataFrame(chain, "id long, lon double, lat double")
    assert {(r["kind"], r["cluster"]) for r in clusters.density_clusters(table, 1.0, 2).collect()} == {("core", 381)}
    assert {r["kind"] for r in clusters.density_clusters(table, 0.5, 2).collect()} == {"noise"}
    assert clusters.density_clusters(table.limit(0), 1.0, 2).collect() == []
