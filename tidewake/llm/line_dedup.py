"""Line deduplication with two Bloom filters, for keys seen once and for keys seen twice.

Every task fills a pair of filters from its lines; pairs merge by blocks of bits, a block's second
filter taking what both first filters hold, so that no key of two documents is ever missed.  Only
keys that the merged second filter suspects are shuffled, as 256-bit cryptographic hashes: counting
them per distinct document confirms repeats and picks the document that keeps its lines.  Documents that
lose lines are marked in a bitmap and meet their dropped keys by a join on ``doc_id``; all others are
rewritten where they stand.

The filter's size follows the number of rows, up to ``MAX_FILTER_BITS`` (64 MB broadcast); beyond,
more lines are suspected and shuffled, the result is the same.

Edge cases: null or empty text is one empty line; rows without a ``doc_id`` are left whole and do not
count as documents; rows that repeat a ``doc_id`` count once; a key twice in one document counts
once, and the keeping document keeps both; a text that loses all lines becomes empty; very long texts
are split whole; an empty table gives an empty result; other columns travel in a struct, their names
may be any.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import at_work, checkpointed, documents, marked, small_batches

BLOCK_BITS = 1 << 19
MAX_FILTER_BITS = 1 << 29
BITS_PER_ROW = 256
MIN_CHARS, MIN_DOCS = 40, 5


def filter_bits(rows: int) -> int:
    """A power of two of bits for a table of so many rows, within fixed bounds."""
    return min(MAX_FILTER_BITS, max(BLOCK_BITS, 1 << (max(rows, 1) * BITS_PER_ROW - 1).bit_length()))


def _block(bits: int) -> int:
    return min(bits, BLOCK_BITS)


def line_keys(body: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased."""
    return [line.strip() for line in body.lower().split(b"\n")]


def counts_as(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)


def _counted(body: bytes, min_chars: int) -> list[bytes]:
    return [key for key in set(line_keys(body)) if counts_as(key, min_chars)]


def _confirmed_by(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=32).digest()


def _positions(digests: np.ndarray, bits: int) -> np.ndarray:
    """Two bits for each digest (rows of two 64-bit words), both in one block."""
    size = np.uint64(_block(bits))
    block = digests[:, 0] % (np.uint64(bits) // size) * size
    low = digests[:, 1]
    inner = np.stack([low % size, (low >> np.uint64(32)) % size], 1)
    return inner + block[:, None]


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool).all(axis=1)


def _put(bitmap: np.ndarray, at: np.ndarray) -> None:
    at = np.unique(at)
    np.bitwise_or.at(bitmap, at >> np.uint64(3), np.left_shift(1, at & np.uint64(7)).astype(np.uint8))


def _words(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def _filler(bits: int, min_chars: int):
    def fill(batches):
        at_work("lines")
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            seen = [xxhash.xxh3_128_digest(key) for body in batch.column(0) for key in _counted(body.as_py(), min_chars)]
            if not seen:
                continue
            words, times = np.unique(_words(seen), axis=0, return_counts=True)
            at = _positions(words, bits)
            _put(twice, at[(times > 1) | _has(once, at)])
            _put(once, at)
        step = _block(bits) // 8
        for i in range(bits // _block(bits)):
            part = slice(i * step, (i + 1) * step)
            if once[part].any():
                packed = [zlib.compress(x[part].tobytes(), 1) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], ["block", "once", "twice"])

    return fill


def _merge(batches):
    """Blocks come sorted; one pair of bitmaps is held at a time."""
    now, once, twice = None, None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["block", "twice"])

    for batch in batches:
        for block, first, second in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            first, second = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (first, second))
            if block != now:
                if now is not None:
                    yield row()
                now, once, twice = block, first.copy(), second.copy()
            else:
                twice |= second | (once & first)
                once |= first
    if now is not None:
        yield row()


def repeated_filter(bodies: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The merged filter of keys in two documents or more; at most ``MAX_FILTER_BITS`` reach the driver."""
    pairs = bodies.mapInArrow(_filler(bits, min_chars), "block long, once binary, twice binary")
    merged = pairs.repartition("block").sortWithinPartitions("block").mapInArrow(_merge, "block long, twice binary")
    bitmap, step = np.zeros(bits // 8, np.uint8), _block(bits) // 8
    for row in merged.collect():
        bitmap[row["block"] * step :][:step] = np.frombuffer(zlib.decompress(bytes(row["twice"])), np.uint8)
    return bitmap


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int | None = None) -> DataFrame:
    """All columns of ``docs`` as a struct ``doc``, with ``kept`` (the new text), ``n_lines`` and ``n_dropped``."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    bits = bits or filter_bits(docs.count())
    known = docs.filter(F.col("doc_id").isNotNull())
    with small_batches(spark):
        bitmap = spark.sparkContext.broadcast(repeated_filter(known.select(body.alias("body")), bits, min_chars))

    def suspected(keys: list[bytes]) -> list[bytes]:
        if not keys:
            return keys
        hit = _has(bitmap.value, _positions(_words(map(xxhash.xxh3_128_digest, keys)), bits))
        return [_confirmed_by(key) for key, h in zip(keys, hit.tolist(), strict=True) if h]

    @F.arrow_udf("array<binary>")
    def suspects(bodies: pa.Array) -> pa.Array:
        return pa.array([suspected(_counted(x.as_py(), min_chars)) for x in bodies], pa.list_(pa.binary()))

    @F.arrow_udf("struct<kept:string,n_lines:long,n_dropped:long>")
    def rewrite(bodies: pa.Array, drops: pa.Array) -> pa.Array:
        out = []
        for x, drop in zip(bodies, drops, strict=True):
            text = x.as_py()
            lines, gone = text.split(b"\n"), set(drop.as_py() or ())
            kept = lines
            if gone:
                kept = [line for line, key in zip(lines, line_keys(text), strict=True) if not (counts_as(key, min_chars) and _confirmed_by(key) in gone)]
            out.append({"kept": b"\n".join(kept).decode(), "n_lines": len(lines), "n_dropped": len(lines) - len(kept)})
        return pa.array(out, pa.struct([("kept", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]))

    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    with small_batches(spark):
        repeats = checkpointed(rows.filter(F.col("doc_id").isNotNull()).select("doc_id", F.explode(suspects("body")).alias("key")))
    distinct = repeats.distinct()
    confirmed = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).filter(F.col("n") >= min_docs)
    # Written first, so that both sides of the join are dealt for it and a very common line can be split.
    confirmed = checkpointed(confirmed.select("key", "keeper"))
    drops = repeats.join(confirmed, "key").filter(F.col("doc_id") != F.col("keeper"))
    drops = checkpointed(drops.groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_set("key").alias("keys")))

    found, nothing = marked(rows, drops.select("drop_id"), F.col("doc_id")), F.lit(None).cast("array<binary>")
    plain = found.filter("not _marked").select("doc", rewrite("body", nothing).alias("new"))
    touched = found.filter("_marked").join(drops, F.col("doc_id") == F.col("drop_id"), "left").select("doc", rewrite("body", "keys").alias("new"))
    return plain.unionByName(touched).select("doc", "new.*")


def cleaned(docs: DataFrame, **params) -> DataFrame:
    """The columns of ``docs`` with the new text, and ``n_chars`` brought in line where it is there."""
    def column(name: str) -> Column:
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.length("kept").cast("long").alias("n_chars")
        return F.col("doc")[name].alias(name)

    return dedup_lines(docs, **params).select(*[column(c) for c in docs.columns])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    return out.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS ord FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS dropped FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
