"""Digits and bits of AIS messages are the same; rows of a feed are shuffled once before they are read."""

from pyspark.sql import functions as F

from tidewake.functions import text as tx
from tidewake.plans import registry

SF = "/root/testdata/sf0.001"
NAMES = ["", "a", "SHANG HAI 7", "x@y", "äß\U0001f600~`", "longer than twenty characters", "  two  ", "[\\]^_ !\"#$%&'()*+,-./:;<=>?", None]


def test_digits_are_the_bits(spark):
    rows = spark.createDataFrame([(i * 4_294_967_291 - 3, x) for i, x in enumerate(NAMES)], "n long, name string")
    bits = tx.parsed_once(rows, bits=F.concat(tx.bits_of("n", 32), tx.text_bits("name", 20), tx.bits_of("n", 8)))
    digits = F.concat(tx.digits_of("n", 32), tx.text_digits("name", 20), tx.digits_of("n", 8))
    for r in bits.select("name", tx.armoured("bits", 424).alias("a"), tx.armoured_digits(digits, 424).alias("b")).collect():
        assert r["a"] == r["b"] and (r["a"] is None) == (r["name"] is None)


def test_text_at_whole_digits(spark):
    field = F.concat(F.lit("0"), tx.text_digits("name", 20), F.lit("0" * 9))
    at = lambda start: tx.bits_text("bits", start, 20)
    one = [F.substring(F.lit(tx.SIX_BIT_TEXT), tx.bits_unsigned("bits", 4 + 6 * i, 6).cast("int") + 1, F.lit(1)) for i in range(20)]
    rows = spark.createDataFrame([(x,) for x in NAMES], "name string").withColumn("bits", field)
    for r in rows.select(at(4).alias("a"), F.rtrim(F.substring_index(F.concat(*one), "@", 1)).alias("b")).collect():
        assert r["a"] == r["b"]


def test_reassembly_is_planned_without_repeats(spark):
    frame = registry.QUERIES["ais_reassembly"](spark, SF)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(", 2, 16") == 0 and plan.count("RepartitionByExpression") == 2
    frame.collect()
    # One of the two is computed, the other reads it.
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()
