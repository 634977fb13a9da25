"""Table access, shared storage and small vector helpers used by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_BATCH = 512
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
BITS_PER_ID, MIN_ID_BITS, MAX_ID_BITS = 32, 1 << 16, 1 << 29


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` alone, so that other columns of the table cannot clash; null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; where that is unset, a temporary folder, for a local master alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='tidewake-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """For jobs that run inside: whole texts stand in the rows, so fewer of them go to an Arrow batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TEXT_BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_caches: dict[str, Callable[[], None]] = {}


def at_work(owner: str, release: Callable[[], None] = lambda: None) -> None:
    """Called in a task: what other operators have cached in this Python worker is let go; ``release`` does so for ``owner`` later."""
    others = [name for name in _caches if name != owner]
    for name in others:
        _caches.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    _caches[owner] = release


def marked(rows: DataFrame, ids: DataFrame, of: Column, name: str = "_marked") -> DataFrame:
    """``rows`` with a column ``name``: true where the one column of ``ids`` holds ``of``, and for few others.

    A bitmap of hashed identifiers is broadcast in parts of 32,768 bits.  It has ``BITS_PER_ID`` bits an
    identifier and ``MAX_ID_BITS`` (64 MB) at most.  When it fills up, more rows are marked; an exact join
    has to follow for those.  Null is never marked.
    """
    known = ids.select(F.col(ids.columns[0]).cast("long").alias("id")).filter("id is not null")
    bits = min(MAX_ID_BITS, max(MIN_ID_BITS, 1 << (BITS_PER_ID * max(1, known.count()) - 1).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    at = known.select(place(F.col("id")).alias("bit"))
    part, held, bit = (f"{name}_{x}" for x in ("part", "bits", "bit"))
    parts = at.groupBy(F.bitmap_bucket_number("bit").alias(part)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias(held))
    placed = rows.withColumn(bit, F.when(of.isNotNull(), place(of.cast("long"))))
    met = placed.join(F.broadcast(checkpointed(parts)), F.bitmap_bucket_number(bit) == F.col(part), "left")
    inner = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col(held), F.shiftright(inner, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (inner % 8).cast("int")) == 1
    return met.withColumn(name, F.coalesce(hit, F.lit(False))).drop(part, held, bit)


def ascii_lower(col):
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a finished intermediate table through Hadoop's file system, wherever it lives."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
