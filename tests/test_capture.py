from tidewake.operators import trajectory


def test_capture_streams_a_ship_over_batches(spark, capsys):
    rows = [(m, t * 700 + m) for m in range(5) for t in range(900 if m == 2 else 40)]
    hits = spark.createDataFrame(rows[::-1], "mmsi long, t long").repartition(3)
    expected = set()
    for m in range(5):
        end = None
        for t in sorted(t for ship, t in rows if ship == m):
            if end is None or t - 5400 > end:
                end = t + 5400
                expected.add((m, t - 5400, end))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        out = trajectory.greedy_capture(hits)
        assert [tuple(r) for r in sorted(out.collect())] == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    out.explain()
    plan = capsys.readouterr().out
    assert sorted(map(tuple, trajectory.greedy_capture(hits, longest=50).collect())) == sorted(expected)
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
