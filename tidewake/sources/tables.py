"""Files and databases: readers with declared schemas, pushed-down predicates and one-file exports."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.functions.text import commas_to_semicolons


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``; a temporary folder where that is unset, for a local master alone."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='tidewake-')}")
    return df.checkpoint(eager=True)


def day_paths(pattern: str, days: list[int]) -> list[str]:
    """Paths with zero-padded days for ``{day}``."""
    return [pattern.format(day=f"{d:02d}") for d in days]


def read_days(spark: SparkSession, pattern: str, days: list[int], schema: str, fmt: str = "csv", **options) -> DataFrame:
    """The union of one file a day in a single read; rows that do not fit the schema are dropped."""
    return spark.read.options(mode="DROPMALFORMED", **options).schema(schema).format(fmt).load(day_paths(pattern, days))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_jdbc(spark: SparkSession, url: str, table: str, predicates: list[str] | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table; one partition per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {}) if predicates else spark.read.jdbc(url, table, properties=properties or {})


def read_excel(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """A small sheet; needs an Excel engine for pandas."""
    import pandas as pd

    return spark.createDataFrame(pd.read_excel(path, **options), schema)


def export_csv(rows: DataFrame, path: str) -> None:
    """One file with a header, for hand-over; large results belong in ``write.parquet``."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def cleaned_register(*parts: DataFrame, name: str = "name", order: list[str] | None = None) -> DataFrame:
    """The union of register parts, separators stripped, one row a normalised name.

    Of several rows of a name the one of the earliest part stays, in it that which is least by ``order``, then by all other columns; nulls come first.
    """
    whole = parts[0].withColumn("_part", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        whole = whole.unionByName(part.withColumn("_part", F.lit(i)), allowMissingColumns=True)
    columns = [c for c in whole.columns if c != "_part"]
    rest = [c for c in columns if c != name]
    first = [*(order or []), *[c for c in rest if c not in (order or [])]]
    rows = whole.withColumn(name, F.lower(F.regexp_replace(name, r"[,\s]", "")))
    kept = rows.groupBy(name).agg(F.min(F.struct("_part", *first)).alias("kept"))
    return kept.select(*[F.col(name) if c == name else F.col(f"kept.{c}").alias(c) for c in columns])


def static_register(spark: SparkSession, url: str, table: str, text: str = "destination", predicates: list[str] | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table of ships whose free ``text`` holds no commas any more, so that it can be written as such a file."""
    rows = read_jdbc(spark, url, table, predicates, properties)
    known = next(c for c in rows.columns if c.lower() == text.lower())
    return rows.withColumn(known, commas_to_semicolons(F.col(known)))
