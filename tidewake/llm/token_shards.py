"""Token ids in binary shards, in training order.

Every task concatenates the ids of its documents and cuts them into sequences of one length.  A
sequence is known by its task and its number there; a keyed Feistel network with cycle-walking permutes
the domain of all such pairs, and the permuted domain is split into equal ranges, one a shard and one
a task.  Range tasks sort their sequences and write them at a fixed stride of little-endian unsigned
16-bit ids.  The global slot of a sequence is its rank in the permuted order: the slots of a shard follow
those of the shards before it, so training reads the shards one after another and resumes at any slot
by one seek.  The order is fixed by the key and by how the input is split into tasks; the index keeps it.

There is a shard for every ``SHARD_BYTES`` of text; as an id takes two bytes and stands for one byte at
least, a shard is about twice that at most, however many there are.

Shards are written under names of their own attempt, the table ``_index`` names those that count.

Edge cases: null text is empty and adds the end id alone; a null ``doc_id`` is listed as null; repeated
rows are written each; the last sequence of a task is filled up with end ids; an empty table
gives no shard; a very long text fills as many sequences as it needs; places are distinct, so there are no
ties; of a table's columns ``doc_id`` and ``text`` alone are read, others may have any name.
"""

from __future__ import annotations

import itertools
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import documents, shared_dir, texts
from tidewake.llm.feistel import permute_array
from tidewake.llm.packing import VOCABULARY, load

LENGTH, END_ID, KEY = 1024, 49407, 20240229
PER_TASK = 1 << 32
SHARD_BYTES = 64 << 20


def _cutter(path: str, length: int, end_id: int, domain: int, key: int):
    end = np.array([end_id], "<u2").tobytes()

    def cut(batches):
        task, number, held, owners = TaskContext.get().partitionId(), 0, bytearray(), []
        step = 2 * length
        if load(path).tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the ids of this vocabulary do not fit in 16 bits")

        def rows(parts, listed):
            nonlocal number
            if number + len(parts) > PER_TASK:
                raise ValueError(f"over {PER_TASK} sequences in a task")
            index = task * PER_TASK + number + np.arange(len(parts))
            number += len(parts)
            return pa.RecordBatch.from_arrays([pa.array(permute_array(index, domain, key)), pa.array(parts, pa.binary()), pa.array(listed, pa.list_(pa.int64()))], ["place", "ids", "doc_ids"])

        for batch in batches:
            parts, listed = [], []
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held += np.frombuffer(load(path).encode(body.as_py()), "<u4").astype("<u2").tobytes() + end
                owners.append(doc_id)
                while len(held) >= step:
                    parts.append(bytes(held[:step]))
                    listed.append(owners)
                    del held[:step]
                    owners = [doc_id] if held else []
                if len(parts) >= 2048:
                    yield rows(parts, listed)
                    parts, listed = [], []
            if parts:
                yield rows(parts, listed)
        if held:
            yield rows([bytes(held) + end * ((step - len(held)) // 2)], [owners])

    return cut


def _shard_writer(path: str):
    def write(batches):
        context = TaskContext.get()
        shard, name, out, position = None, "", None, 0
        for batch in batches:
            rows = []
            for at, place, ids, owners in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                if at != shard:
                    if out is not None:
                        out.close()
                    filesystem, inner = pyarrow.fs.FileSystem.from_uri(path)
                    filesystem.create_dir(inner, recursive=True)
                    shard, position = at, 0
                    name = f"shard-{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.bin"
                    out = filesystem.open_output_stream(f"{inner}/{name}")
                ids = ids.as_py()
                out.write(ids)
                rows.append((shard, name, position, place, zlib.crc32(ids), owners))
                position += 1
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["shard", "file", "position", "place", "ids_crc32", "doc_ids"])
        if out is not None:
            out.close()

    return write


_INDEX = "shard long, file string, position long, place long, ids_crc32 long, doc_ids array<long>"


def write_shards(docs: DataFrame, path: str, vocabulary: str, length: int = LENGTH, end_id: int = END_ID, key: int = KEY, shards: int | None = None) -> DataFrame:
    """Write the shards below ``path``; one row a sequence: ``slot, shard, file, position, ids_crc32, doc_ids``."""
    spark = docs.sparkSession
    bodies = texts(docs).select("doc_id", F.col("text").cast("binary").alias("body"))
    shards = shards or max(1, -(-(bodies.agg(F.sum(F.octet_length("body") + 1)).first()[0] or 0) // SHARD_BYTES))
    domain = max(1, bodies.rdd.getNumPartitions()) * PER_TASK
    sequences = bodies.mapInArrow(_cutter(vocabulary, length, end_id, domain, key), "place long, ids binary, doc_ids array<long>")
    width = -(-domain // shards)
    ranged = sequences.select(F.expr(f"place div {width}").alias("shard"), "place", "ids", "doc_ids")
    ordered = ranged.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("place")
    ordered.mapInArrow(_shard_writer(path), _INDEX).write.parquet(f"{path}/_index")
    return shard_index(spark, path)


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """The sequences of a directory of shards with their global slots; the driver adds up one count a shard."""
    rows = spark.read.schema(_INDEX).parquet(f"{path}/_index")
    counts = sorted((r["shard"], r["count"]) for r in rows.groupBy("shard").count().collect())
    before = itertools.accumulate((n for _, n in counts), initial=0)
    starts = spark.createDataFrame([(shard, first) for (shard, _), first in zip(counts, before, strict=False)], "shard long, first long")
    return rows.join(starts, "shard").select((F.col("first") + F.col("position")).alias("slot"), "shard", "file", "position", "ids_crc32", "doc_ids")


def read_slots(index: DataFrame, path: str, first: int, count: int, length: int = LENGTH) -> list[np.ndarray]:
    """The ids in slots ``first`` to ``first + count``, in order: one seek a shard."""
    runs = index.filter(F.col("slot").between(first, first + count - 1)).groupBy("shard", "file").agg(F.min("position").alias("position"), F.count(F.lit(1)).alias("n")).orderBy("shard").collect()
    out: list[np.ndarray] = []
    filesystem, inner = pyarrow.fs.FileSystem.from_uri(path)
    for run in runs:
        with filesystem.open_input_file(f"{inner}/{run['file']}") as handle:
            block = handle.read_at(run["n"] * 2 * length, run["position"] * 2 * length)
        out += list(np.frombuffer(block, "<u2").reshape(-1, length))
    return out


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_shards(documents(spark, sf_dir), shared_dir(spark, "shards"), public_tokenizers.path(VOCABULARY))
    return index.select("slot", "shard", "position", "ids_crc32", "doc_ids")
