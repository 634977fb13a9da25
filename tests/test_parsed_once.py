"""Lines are taken apart once a row, however many fields and filters follow."""

from tidewake.plans import registry
from tidewake.sources import ais

SF = "/root/testdata/sf0.001"


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_position_lines_are_split_once(spark):
    plan = _plan(registry.QUERIES["position_text"](spark, SF))
    assert plan.count("split(") == 1 and plan.count("get_json_object(") == 1


def test_feed_lines_are_split_once(spark):
    for rows in ais.at_feed(spark.range(9).selectExpr("concat(id, '@x') as value")):
        assert _plan(rows).count("split(") == 1


def test_position_lines_that_do_not_fit(spark):
    lines = ["1,2,3.5,4.5,5,6,7,8,9,0", "1,2,3.5,4.5,5,6,7,8,9,0,more", "1,2,3.5,4.5,5,6,7,8,9", "1,2,x,4.5,5,6,7,8,9,0", ",2,3.5,4.5,5,6,7,8,9,0", "", None]
    got = ais.position_text(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in got] == [(1, 2, 3.5, 4.5, 5, 6, 7.0, 8.0, 9.0, 0.0)] * 2
