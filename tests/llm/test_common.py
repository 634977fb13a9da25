import pytest
from pyspark.sql import functions as F

from tidewake.llm import common


def test_marked_misses_nothing_and_little_else(spark, monkeypatch):
    ids = spark.range(0, 50_000, 7).unionByName(spark.createDataFrame([(None,), (-5,)], "id long"))
    every = spark.range(-10, 60_000).unionByName(spark.createDataFrame([(None,)], "id long"))
    inside = lambda i: i is not None and (i == -5 or 0 <= i < 50_000 and i % 7 == 0)
    got = {r["id"]: r["m"] for r in common.marked(every, ids, F.col("id"), "m").collect()}
    assert got[None] is False and all(got[i] for i in got if inside(i))
    assert sum(m and not inside(i) for i, m in got.items()) < 0.05 * len(got)
    monkeypatch.setattr(common, "MAX_ID_BITS", common.MIN_ID_BITS)
    full = {r["id"]: r["m"] for r in common.marked(every, ids, F.col("id"), "m").collect()}
    assert all(full[i] for i in full if inside(i)) and full[None] is False
    assert not any(r["m"] for r in common.marked(every, ids.limit(0), F.col("id"), "m").collect())


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session(), "x")
    Context.master = "local[3]"
    assert common.shared_dir(Session(), "x").startswith("file:///")
