"""Visits at the edge of the gap, and points without a time, against the SQL of the query."""

import datetime as dt

import duckdb

from tidewake.plans import registry
from tidewake.streaming import live

START = dt.datetime(2024, 1, 2)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_site_sessions_at_the_edge_of_the_gap(spark, tmp_path):
    after = lambda ship, *seconds: [(ship, None if s is None else START + dt.timedelta(seconds=s)) for s in seconds]
    seen = after(1, 0, 86_400) + after(2, 0, 86_399, 2 * 86_399) + after(3, 0.7, 86_400.2) + after(4, 0, 86_401, 86_401) + after(5, 0, None, None) + after(None, 0, None)
    rows = [(i, ts, ship, "view", 1.0, '{"k": 1}') for i, (ship, ts) in enumerate(seen)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    mine = registry.QUERIES["site_sessions"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    theirs = con.sql(registry.SQL["site_sessions"])
    assert mine.columns == theirs.columns
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(theirs.fetchall(), key=repr)


def test_streamed_visits_at_the_edge_of_the_gap(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, START + dt.timedelta(seconds=s)) for s in (0, 1800, 3599, 90_000, 200_000)], "mmsi long, site long, ts timestamp")
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.parquet(path)
    stream = live.sessions(spark.readStream.schema(rows.schema).parquet(path))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "seen")).trigger(availableNow=True).start().awaitTermination(120)
    got = spark.read.parquet(out).selectExpr("unix_timestamp(begin_ts) - unix_timestamp(timestamp '2024-01-02') as b", "unix_timestamp(end_ts) - unix_timestamp(timestamp '2024-01-02') as e", "n_points").collect()
    assert sorted(map(tuple, got)) == [(0, 1800, 1), (1800, 5399, 2), (90_000, 91_800, 1)]
