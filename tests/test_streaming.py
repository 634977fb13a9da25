"""Streams give what the batch operators give on the same rows."""

import pytest
from pyspark.sql import functions as F

from tidewake.functions.geo import haversine_km
from tidewake.operators import stops
from tidewake.sources.fixtures import points
from tidewake.streaming import live

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily"))
    p = points(spark, SF).select("mmsi", "event_id", "t", "lon", "lat", "site", F.timestamp_seconds("t").alias("ts"))
    for i in range(3):
        p.filter(f"(t div 864000) % 3 = {i}").coalesce(1).orderBy("t").write.mode("append").parquet(path)
    return path, p


def drained(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def _stops(spark, p, tmp_path, batches, late, **more):
    """What the stream has found after all batches and a far point that moves the watermark on."""
    path, out, seen = (str(tmp_path / x) for x in ("in", "out", "seen"))
    (tmp_path / "in").mkdir()
    stream = live.stop_stream(live.position_stream(spark, path, p.schema, files_per_trigger=1), late=late, **more)
    far = spark.createDataFrame([(-1, -1, 1 << 33, 0.0, 0.0)], p.schema)
    for rows in [*batches, far, far.withColumn("t", F.col("t") + 1)]:
        rows.coalesce(1).write.mode("append").parquet(path)
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", seen).trigger(availableNow=True).start()
        q.awaitTermination(120)
    return sorted(tuple(r) for r in spark.read.parquet(out).collect())


def _expected(p, all_of_them=False):
    batch = stops.summarised(stops.stop_members(p)).select("mmsi", "stop", "begin_t", "end_t", "point_num").collect()
    last = {r["mmsi"]: r["t"] for r in p.groupBy("mmsi").agg(F.max("t").alias("t")).collect()}
    return sorted(tuple(r) for r in batch if all_of_them or r["end_t"] < last[r["mmsi"]])


def _ship_points(spark):
    return points(spark, SF).select("mmsi", "event_id", "t", "lon", "lat")


def test_stops_go_on_over_batches(spark, tmp_path):
    p = _ship_points(spark)
    days = [r[0] for r in p.select(F.expr("t div 259200")).distinct().orderBy(1).collect()]
    assert _stops(spark, p, tmp_path, [p.filter(f"t div 259200 = {day}") for day in days], "0 seconds") == _expected(p)


def test_late_points_are_taken_in_order(spark, tmp_path):
    """Points arrive up to four days late, dealt by a hash; the stops are those of the points in order."""
    p = _ship_points(spark)
    arrival = F.col("t") + F.pmod(F.xxhash64("event_id"), F.lit(4 * 86_400))
    span = p.agg(F.min("t"), F.max("t")).first()
    width = (span[1] + 4 * 86_400 - span[0]) // 6 + 1
    batches = [p.filter((arrival >= span[0] + i * width) & (arrival < span[0] + (i + 1) * width)) for i in range(6)]
    assert _stops(spark, p, tmp_path, batches, "12 days") == _expected(p)


def test_quiet_ships_close_their_stops(spark, tmp_path):
    p = _ship_points(spark)
    got = _stops(spark, p, tmp_path, [p], "0 seconds", quiet_s=40 * 86_400)
    assert got == _expected(p, all_of_them=True)


def test_latest_position_in_windows(spark, daily):
    path, p = daily
    stream = live.position_stream(spark, path, p.schema)
    got = drained(live.latest_in_window(stream, late="40 days"), "latest", "complete")
    batch = p.groupBy(F.window("ts", "10 minutes", "5 minutes"), "mmsi").agg(F.max(F.struct("ts", "event_id", "lon", "lat")).alias("row")).select(F.col("window.start").alias("window_start"), "mmsi", "row.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_changes_and_counts(spark, daily):
    path, p = daily
    got = drained(live.changed_only(live.position_stream(spark, path, p.schema), ["mmsi", "site"], late="40 days"), "changes", "append")
    assert got.count() == p.select("mmsi", "site").distinct().count()


def test_exact_counts_in_windows(spark, daily, tmp_path):
    """Two states in a row: the second one gives a window's count once the watermark has passed it."""
    _, p = daily
    path, out, seen = (str(tmp_path / x) for x in ("in", "out", "seen"))
    far = p.limit(1).withColumns({"ts": F.timestamp_seconds(F.lit(1 << 33)), "lon": F.lit(122.5), "lat": F.lit(30.5)})
    p.filter("event_id % 2 = 0").write.parquet(path)
    counts = live.circle_counts(live.position_stream(spark, path, p.schema), 122.5, 30.5, 60.0, width="1 day", late="40 days")
    for rows in (p.filter("event_id % 2 = 1"), far, far.withColumn("ts", F.timestamp_seconds(F.lit((1 << 33) + 1)))):
        rows.write.mode("append").parquet(path)
        q = counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", seen).trigger(availableNow=True).start()
        q.awaitTermination(120)
    near = p.filter(haversine_km("lon", "lat", F.lit(122.5), F.lit(30.5)) < 60)
    batch = near.groupBy(F.window("ts", "1 day")).agg(F.countDistinct("mmsi").alias("n_ships"), F.count(F.lit(1)).alias("n_points")).select(F.col("window.start").alias("window_start"), "n_ships", "n_points")
    want = sorted(map(tuple, batch.collect()))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want and len(want) > 5
