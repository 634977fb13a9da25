"""Planned calls with text that cannot be read, short lists of berths, rule bands, and repeated rows."""

import random

from pyspark.sql import functions as F

from tidewake.operators import compress, planning, rules


def test_text_that_cannot_be_read(spark):
    texts = ["7-10万", "2.5-5万", "2000-50000", "5万", "", None, "x-y", " 3 - 4 万", "1-99999999999"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("r", planning.berth_tonnage(F.col("t"))).orderBy("i").collect()
    assert [tuple(r["r"]) for r in rows] == [(70_000, 100_000), (25_000, 50_000), (2000, 50_000), (5, 5), (None, None), (None, None), (None, None), (30_000, 40_000), (1, None)]
    times = spark.createDataFrame([("05/0830",), ("05/1300",), ("05",), ("",), (None,), ("05/soon",)], "io_time string")
    assert [r[0] for r in times.select(planning.is_morning("io_time")).collect()] == [True, False, False, False, False, False]


def test_short_lists_of_berths(spark):
    lists = spark.createDataFrame([("north1/2/3",), ("B3/B12",), ("B3/12",), ("7/8",), ("",), (None,)], "berths string")
    assert [r[0] for r in lists.select(planning.berth_names(F.col("berths"))).collect()] == [["north1", "north2", "north3"], ["B3", "B12"], ["B3", "B12"], ["7", "8"], [""], None]
    plans = spark.createDataFrame([(1, "bulk", 30_000, "B3/12"), (2, "bulk", 30_000, "B12/3"), (3, "bulk", 30_000, "B12/4"), (4, "bulk", 30_000, None), (5, "bulk", 30_000, "B9")], "plan int, type string, dwt int, berths string")
    berths = spark.createDataFrame([("B12", "2-4万", "bulk"), ("B3", "5-9万", "bulk"), ("B9", "many", "bulk")], "berth string, tonnage string, berth_type string")
    assert {r["plan"]: r["suits"] for r in planning.plan_berths(plans, berths).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_bands_of_close_and_open_ended_rules(spark):
    rng = random.Random(4)
    spans = [(i, i % 7, low, low + rng.uniform(0, 9)) for i, low in enumerate(rng.uniform(0, 500) for _ in range(300))] + [(300, 9, 480.0, 1e9), (301, 8, -1e9, 3.0), (302, 7, 20.0, 20.0)]
    values = [(i, x) for i, x in enumerate([rng.uniform(-20, 600) for _ in range(300)] + [20.0, 1e8, -1e8, 1e10, None])]
    known = spark.createDataFrame(spans, "seq int, level int, low double, high double")
    got = {r["id"]: r["level"] for r in rules.range_lookup(spark.createDataFrame(values, "id int, v double"), ["id"], "v", known, "level").collect()}
    last = lambda v: max(((s, n) for s, n, low, high in spans if v is not None and low <= v <= high), default=(0, None))[1]
    assert got == {i: last(v) for i, v in values}
    assert {r["level"] for r in rules.range_lookup(spark.createDataFrame(values, "id int, v double"), ["id"], "v", known.limit(0), "level").collect()} == {None}


def test_repeated_rows_of_a_compressed_track(spark):
    rows = [(1, i, 60 * (i // 2), 121.0 + 0.01 * (i // 2), 30.0, 1.0) for i in range(20)]
    p = spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double, sog double")
    whole = compress.compressed(p, 50.0, "dp", None).collect()
    once = compress.compressed(p, 50.0, "dp", None, once=["mmsi", "t", "lon", "lat"])
    assert once.columns == p.columns and sorted((r["t"], r["event_id"]) for r in once.collect()) == sorted({r["t"]: r["event_id"] for r in sorted(whole, key=lambda r: -r["event_id"])}.items())
