"""Importance resampling towards a target corpus by hashed runs of words.

A feature is a run of one to ``LONGEST`` consecutive words, its bucket the CRC-32 of its bytes modulo
``BUCKETS``.  Each task keeps a trie of words: a node is a run, it holds the CRC state after its bytes,
so that a longer run continues from it, how often the run was met, and, when documents are scored, the
gain of its bucket.  The first walk over a table fills the counts; what the nodes of a task hold is
added up per bucket, ``BUCKETS`` rows a task at most, and Spark merges the totals.  The second walk finds the
same runs with their gains attached and gives a document the floored mean over its runs.  A trie that
reaches ``MAX_NODES`` gives up its counts and starts afresh, so memory is bounded and no run is lost.

The draw without replacement takes the highest of weight plus Gumbel noise, and the noise is a function
of the seed and of ``doc_id``.  Ranks come from a range shuffle: places within a partition plus the sizes of those before.

Edge cases: null and empty texts have no features and weight 0; very long texts are walked in pieces of
``PIECE_BYTES``, each with the words before it; rows of equal score are ranked by ``doc_id``; repeated rows are each a
row of their own; rows without a ``doc_id`` have neither score nor rank and do not count towards the number drawn, but their
text counts in the totals; an empty table gives an empty result, an empty target gives gains for a target of no words; columns
other than the identifier and the text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewake.llm.common import at_work, documents, remove_tree, shared_dir, small_batches

BUCKETS, LONGEST = 10_000, 2
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
MAX_NODES = 1 << 19
PIECE_BYTES, WALK_WORDS = 1 << 20, 1 << 17
ELIGIBLE = "coalesce(n_words >= {least} and doc_id is not null, false)"
#: A-Z become a-z; ASCII that is neither letter nor digit parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def pieces(text: bytes, longest: int = LONGEST) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text in pieces, and how many of a piece's first words belong to the piece before."""
    lead, at = [], 0
    while at < len(text) or at == 0:
        end = at + PIECE_BYTES
        folded = text[at:end].translate(_FOLD)
        while end < len(text) and not folded.endswith(b" "):
            more = text[end : end + 256].translate(_FOLD)
            cut = more.find(b" ")
            folded += more if cut < 0 else more[: cut + 1]
            end += 256 if cut < 0 else cut + 1
        words = lead + folded.split()
        yield words, len(lead)
        lead, at = words[-(longest - 1) :] if longest > 1 else [], end


class _Numbered(dict):
    """Numbers keys as they come; ``fresh`` lists those that are new since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class _Level:
    """The nodes of one depth: their CRC states, the buckets of those, and how often each was met."""

    def __init__(self, buckets: int):
        self.numbers, self.buckets = _Numbered(), buckets
        self.crc: list[int] = []
        self.bucket = np.zeros(1024, np.int64)
        self.count = np.zeros(1024, np.int64)

    def grow(self, states: list[int]) -> None:
        had, now = len(self.crc), len(self.crc) + len(states)
        self.crc += states
        if now > len(self.bucket):
            more = max(now, 2 * len(self.bucket)) - len(self.bucket)
            self.bucket, self.count = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.bucket, self.count))
        self.bucket[had:now] = np.array(states, np.int64) % self.buckets
        self.numbers.fresh = []


class WordTrie:
    """Runs of up to ``longest`` words.  A child is found under its parent's number and that of its last word alone."""

    def __init__(self, gains: np.ndarray | None = None, longest: int = LONGEST, buckets: int = BUCKETS):
        self.gains, self.longest, self.buckets = gains, longest, buckets
        self.totals = np.zeros(buckets, np.int64)
        self.clear()

    def clear(self) -> None:
        self.levels = [_Level(self.buckets) for _ in range(self.longest)]
        self.words: list[bytes] = []

    def __len__(self) -> int:
        return sum(len(level.crc) for level in self.levels)

    def _firsts(self, words: list[bytes]) -> np.ndarray:
        level = self.levels[0]
        found = list(map(level.numbers.__getitem__, words))
        self.words += level.numbers.fresh
        level.grow([zlib.crc32(w) for w in level.numbers.fresh])
        return np.array(found, np.int64)

    def _children(self, depth: int, parents: np.ndarray, lasts: np.ndarray) -> np.ndarray:
        level, above, words = self.levels[depth], self.levels[depth - 1].crc, self.words
        found = list(map(level.numbers.__getitem__, (parents << 32 | lasts).tolist()))
        level.grow([zlib.crc32(words[k & 0xFFFFFFFF], zlib.crc32(b" ", above[k >> 32])) for k in level.numbers.fresh])
        return np.array(found, np.int64)

    def walk(self, words: list[bytes], owner: np.ndarray, lead: np.ndarray) -> Iterator[tuple[_Level, np.ndarray, np.ndarray]]:
        """By depth the owner and the node of every run that ends at a word outside ``lead``; runs stay within their owner."""
        if len(self) > MAX_NODES:
            self.spill()
        lasts = nodes = self._firsts(words)
        for depth in range(self.longest):
            if depth:
                within = owner[depth:] == owner[: len(owner) - depth]
                grown = np.full(max(0, len(words) - depth), -1, np.int64)
                grown[within] = self._children(depth, nodes[:-1][within], lasts[depth:][within])
                nodes = grown
            taken = (nodes >= 0) & ~lead[depth:]
            yield self.levels[depth], owner[depth:][taken], nodes[taken]

    def spill(self) -> None:
        """Counts go into the totals of their buckets and the trie starts afresh."""
        for level in self.levels:
            n = len(level.crc)
            np.add.at(self.totals, level.bucket[:n], level.count[:n])
        self.clear()

    def add(self, words: list[bytes], owner: np.ndarray, lead: np.ndarray) -> None:
        for level, _, nodes in self.walk(words, owner, lead):
            met = np.bincount(nodes, minlength=len(level.crc))
            level.count[: len(met)] += met

    def gained(self, words: list[bytes], owner: np.ndarray, lead: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs and their summed gains for each of the ``owners``."""
        size, gain = np.zeros(owners, np.int64), np.zeros(owners, np.int64)
        for level, who, nodes in self.walk(words, owner, lead):
            size += np.bincount(who, minlength=owners)
            # Sums of whole numbers far below 2 ** 53 are exact in doubles.
            gain += np.bincount(who, weights=self.gains[level.bucket[nodes]], minlength=owners).astype(np.int64)
        return size, gain


def _walks(texts: pa.Array, longest: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Words of some texts at a time, about ``WALK_WORDS`` of them, with the row of each and whether it only leads in."""
    words, owner, lead = [], [], []
    for row, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        for piece, before in pieces(text or b"", longest):
            words += piece
            owner.append(np.full(len(piece), row, np.int64))
            lead.append(np.arange(len(piece)) < before)
            if len(words) >= WALK_WORDS:
                yield words, np.concatenate(owner), np.concatenate(lead)
                words, owner, lead = [], [], []
    if words:
        yield words, np.concatenate(owner), np.concatenate(lead)


def bucket_totals(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all texts fall into each bucket; ``texts`` has the one column ``text``."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("importance")
        trie = WordTrie(None, longest, buckets)
        for batch in batches:
            for walk in _walks(batch.column(0), longest):
                trie.add(*walk)
        trie.spill()
        held = np.flatnonzero(trie.totals)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(trie.totals[held])], ["bucket", "n"])

    with small_batches(texts.sparkSession):
        rows = texts.mapInArrow(totals, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket in thousandths of a nat, floored."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_features, n_words, weight`` of every row."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("importance")
        trie = WordTrie(gains, longest, len(gains))
        for batch in batches:
            rows = batch.num_rows
            size, gain, n_words = (np.zeros(rows, np.int64) for _ in range(3))
            for words, owner, lead in _walks(batch.column(1), longest):
                more, sums = trie.gained(words, owner, lead, rows)
                size, gain = size + more, gain + sums
                n_words += np.bincount(owner[~lead], minlength=rows)
            weight = np.where(size > 0, gain // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n_words), pa.array(weight)], ["doc_id", "n_features", "n_words", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scores, "doc_id long, n_features long, n_words long, weight long")


def gumbel(doc_id: str = "doc_id", seed: int = SEED):
    """Noise in thousandths, floored: a function of the seed and the identifier."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, n_words, weight, score, rank`` of every row of ``docs``; ``rank`` numbers the rows drawn, others have none.

    ``percent`` of the documents of ``least_words`` words and more are drawn, those of the highest score.
    """
    spark = docs.sparkSession
    gains = gains_of(bucket_totals(docs.select("text"), longest, buckets), bucket_totals(target.select("text"), longest, buckets))
    scored, ordered = shared_dir(spark, "importance-scored"), shared_dir(spark, "importance-ordered")
    with small_batches(spark):
        weighted(docs, gains, longest).withColumn("score", F.col("weight") + gumbel(seed=seed)).write.parquet(scored)
    # The places of a range shuffle hold for the run that made them alone, so they are written before they are counted.
    rows = spark.read.parquet(scored).withColumn("eligible", F.expr(ELIGIBLE.format(least=least_words)))
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed.withColumn("part", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).write.parquet(ordered)
    remove_tree(spark, scored)
    rows = spark.read.parquet(ordered)
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("eligible").alias("eligible"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    drawn = (parts.agg(F.sum("eligible")).first()[0] or 0) * percent // 100
    rank = F.col("before") + F.col("place") + 1
    return rows.join(F.broadcast(before), "part").select("doc_id", "n_features", "n_words", "weight", "score", F.when(F.col("eligible") & (rank <= drawn), rank).alias("rank"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def _nibble(n: int) -> int:
    for _ in range(4):
        n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
    return n


#: A CRC-32 takes the hexadecimal digits of a byte from the lower one up, each through a table of sixteen.
_CRC = f"""xor(list_reduce(range(2 * strlen(f)), lambda acc, i: xor(acc >> 4, list_extract({[_nibble(n) for n in range(16)]}::BIGINT[], (xor(acc, strpos('0123456789ABCDEF', h[i - i % 2 + 2 - i % 2]) - 1) & 15) + 1)), 4294967295::BIGINT), 4294967295)"""
SQL = rf"""
WITH texts AS (
  SELECT doc_id, NULL AS item_id, text FROM documents UNION ALL SELECT NULL, item_id, text FROM benchmark
), words AS (
  SELECT doc_id, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), met AS (
  SELECT doc_id, item_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), features AS (
  SELECT f, count(item_id) AS t, count(*) - count(item_id) AS s FROM met GROUP BY f
), placed AS (
  SELECT f, s, t, {_CRC} % {BUCKETS} AS bucket FROM (SELECT *, hex(encode(f)) AS h FROM features)
), totals AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM placed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS})))) AS gain FROM totals, (SELECT sum(s) AS s_all, sum(t) AS t_all FROM totals)
), weights AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight FROM met JOIN placed USING (f) JOIN gains USING (bucket) WHERE item_id IS NULL GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, len(w) AS n_words, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
  FROM words d LEFT JOIN weights USING (doc_id) WHERE d.item_id IS NULL
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS}
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= n * {PERCENT} // 100 THEN rank END AS rank, n_words FROM scored s LEFT JOIN ranked USING (doc_id)
"""
