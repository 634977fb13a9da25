"""Tracks and feeds cut where a scan starts afresh for certain, so that one ship is scanned by many tasks.

A scan in order (a fold) is bound to go through a key's rows one by one, except where a row on its own tells that
nothing before it matters.  Rows are dealt by key and slice of their position; a window within each slice and one over
the ends of slices, of which there are few, find those rows; and each row's home is the slice in which the last of them before
it lies.  The rows of one key and home are whole stretches: they can be scanned by a task of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def homed(rows: DataFrame, keys: list[str], at: str, order: list[str], fresh: Callable[[Callable[[str], Column]], Column], width: float) -> DataFrame:
    """``rows`` with ``home``: the slice, of ``width`` along ``at``, in which the stretch of the row begins.

    ``fresh`` gets a function from a name to that column of the row before, in ``order``, and tells whether the scan starts
    afresh; the first row of a key does.  ``order`` begins with ``at`` and leaves no ties that matter.
    """
    columns = rows.columns
    # Keys and slice in one struct, in which a missing key is a key like any other: rows are shuffled by it once, for the windows, the ends and the join.
    place = F.struct(*keys, F.floor(F.col(at) / F.lit(width)).alias("_slice"))
    dealt = rows.select(place.alias("_place"), *[c for c in columns if c not in keys]).repartition("_place")
    placed = dealt.withColumns({k: F.col(f"_place.{k}") for k in [*keys, "_slice"]})
    within = Window.partitionBy("_place").orderBy(*order)
    over = Window.partitionBy(*keys).orderBy("_slice")
    row = F.struct(*order, *[c for c in columns if c not in order and c not in keys])
    seen = placed.withColumns({"_before": F.lag(row).over(within), "_row": row})
    starts = F.coalesce(fresh(lambda name: F.col(f"_before.{name}")), F.lit(False)) & F.col("_before").isNotNull()
    seen = seen.withColumn("_starts", starts)
    ends = seen.groupBy("_place").agg(F.min_by("_row", F.struct(*order)).alias("_first"), F.max_by("_row", F.struct(*order)).alias("_last"), F.max("_starts").alias("_inside"))
    # The first row of a slice against the last one of the slice before.
    ends = ends.select("*", "_place.*")
    edges = ends.withColumn("_before", F.lag("_last").over(over)).select("_place", *keys, "_slice", "_inside", "_before", "_first.*")
    edge = F.col("_before").isNull() | F.coalesce(fresh(lambda name: F.col(f"_before.{name}")), F.lit(False))
    edges = edges.withColumn("_edge", edge)
    begun = F.when(F.col("_edge") | F.col("_inside"), F.col("_slice"))
    edges = edges.withColumn("_carried", F.last(begun, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))).select(F.col("_place").alias("_of"), "_edge", "_carried")
    passed = F.max("_starts").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = seen.drop("_before", "_row").withColumn("_passed", passed).join(edges, F.col("_place") == F.col("_of"))
    return met.select(*columns, F.when(F.col("_passed") | F.col("_edge"), F.col("_slice")).otherwise(F.col("_carried")).alias("home"))


def any_longer(rows: DataFrame, key: str, longest: int) -> bool:
    """Whether a key has more than ``longest`` rows."""
    return not rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > longest).isEmpty()
