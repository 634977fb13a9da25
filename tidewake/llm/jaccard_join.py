"""Similarity join of word shingle sets by adaptive multi-match prefixes.

Shingles have one global order, rare ones first, after a sketch of their counts over all rows.  Two
sets whose overlap reaches the bound share at least ``l`` shingles within their ``l``-prefixes, for
any ``l``.  Each document takes the ``l`` of least estimated cost: a longer prefix is dearer to scan
and lets more shared shingles be asked for before a pair is verified.  Pairs meet at a shingle of their
shortest prefixes; a pair is a candidate when the longer ones share as many as the smaller of their two
values, more where the two sizes ask for more than the least overlap, counted on the spot by blocks of
an incidence matrix.  A pair comes out at the first of the tokens where it meets.  Where everything is
common, as in a large family of near copies, documents take most of their set for a prefix, and few
pairs come out that are not similar.  Tokens met by the very same documents bring the same pairs, so one
of them stands for all.  Longer prefixes travel as 24 bits a shingle; a chance agreement costs a
verification and loses no link.  The documents of one token are dealt into blocks and every pair of
blocks is a group of its own, so that no task holds more than two blocks.

Equal sets are one class from the start.  A few links between each class and the smallest class with
the same minimum hash come first; pairs within the components that they make need no further look, so
a large family of near copies costs in proportion to its size.  The prefix join then finds every other
pair that can be linked; candidates are verified on their whole texts.

The sketch has a bounded number of slots (``MAX_SLOTS`` bytes are broadcast); when it fills up the order
gets worse and candidates more, the links stay the same.

Edge cases: null text, or one without words, is an empty set, linked with nothing; a text with fewer
words than a shingle has one shingle, its whole sequence; rows that repeat a ``doc_id`` count as one
document that is linked when any of its texts is; a null ``doc_id`` takes part through its equal set
only, and has no component of its own; an empty table gives an empty result; very long texts are hashed
a piece at a time and count whole; of a table's columns ``doc_id`` and ``text`` alone are compared,
others may have any name.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidewake.llm.common import at_work, checkpointed, documents, marked, remove_tree, shared_dir, small_batches, texts
from tidewake.llm.components import connected_components

SLOTS_PER_ROW, MIN_SLOTS, MAX_SLOTS, SLOT_BLOCK = 64, 1 << 16, 1 << 26, 1 << 16
PAIR_BLOCK, VOCABULARY_BLOCK = 1024, 4096
#: Tokens with a count from here on may have groups that one task should not hold; counts stop at 255.
FREQUENT = 200
BODIES_BY_HUB, BROADCAST_HUBS = 256, 100_000
SCAN_COST, PAIR_COST = 1.0, 2.0
HEADS = 3
BYTES_AT_ONCE = 1 << 17
_MIX = (np.uint64(0x9E3779B185EBCA87), np.uint64(29))
_FIRST, _SECOND = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: What words are parted by, as ``bytes.split`` has it too.
_SPACES = b" \t\n\x0b\x0c\r"
#: The key of the words' hashes.
_KEY = 0x2545F4914F6CDD1B
_of_word = functools.partial(xxhash.xxh3_64_intdigest, seed=_KEY)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_of_word, words), np.uint64, len(words))


def _windows(h: np.ndarray, span: int) -> np.ndarray:
    out = np.full(len(h) - span + 1, span, np.uint64)
    for j in range(span):
        out = (out ^ h[j : len(h) - span + 1 + j]) * _MIX[0]
        out ^= out >> _MIX[1]
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.diff(values, prepend=~values[:1]) != 0]


def _long_shingles(body: bytes, width: int) -> np.ndarray:
    """One text, a piece at a time; pieces end at white space."""
    parts, at = [], 0
    while at < len(body):
        end = min(len(body), at + BYTES_AT_ONCE)
        while end < len(body) and body[end] not in _SPACES:
            end += 1
        parts.append(_word_hashes(body[at:end].split()))
        at = end
    h = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return _distinct(_windows(h, min(width, len(h)))) if len(h) else h


def _short_shingles(bodies: list[bytes], width: int) -> list[np.ndarray]:
    split = [b.split() for b in bodies]
    h = _word_hashes([w for words in split for w in words])
    whole = _windows(h, width) if len(h) >= width else h[:0]
    out, first = [], 0
    for n in map(len, split):
        last = first + n
        out.append(_distinct(whole[first : last - width + 1] if n >= width else _windows(h[first:last], n)) if n else h[:0])
        first = last
    return out


def shingle_sets(bodies: list[bytes], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles; words are hashed by a keyed XXH3, whole."""
    out, held, size = [], [], 0
    for body in bodies:
        body = body.lower()
        if held and size + len(body) > BYTES_AT_ONCE:
            out += _short_shingles(held, width)
            held, size = [], 0
        if len(body) >= BYTES_AT_ONCE:
            out.append(_long_shingles(body, width))
        else:
            held.append(body)
            size += len(body) + 1
    return out + (_short_shingles(held, width) if held else [])


def least_overlap(n: int, percent: int) -> int:
    """The fewest common shingles with which a set of ``n`` reaches the similarity."""
    return -(-percent * n // 100)


def _slots(tokens: np.ndarray, slots: int) -> np.ndarray:
    return (tokens * _FIRST >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)


def _counter(width: int, slots: int):
    def count(batches):
        at_work("shingles")
        counts = np.zeros(slots, np.uint16)
        for batch in batches:
            bodies = batch.column(0)
            for start in range(0, len(bodies), 256):
                sets = shingle_sets(bodies[start : start + 256].to_pylist(), width)
                at, times = np.unique(_slots(np.concatenate(sets), slots), return_counts=True)
                counts[at] = np.minimum(counts[at] + times, 255)
        for i in range(0, slots, SLOT_BLOCK):
            part = counts[i : i + SLOT_BLOCK].astype(np.uint8)
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["slot", "counts"])

    return count


def _summed(batches):
    """Blocks come sorted; counts stop at 255."""
    now, total = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([zlib.compress(np.minimum(total, 255).astype(np.uint8).tobytes(), 1)], pa.binary())], ["slot", "counts"])

    for batch in batches:
        for slot, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(packed.as_py()), np.uint8)
            if slot != now:
                if now is not None:
                    yield row()
                now, total = slot, part.astype(np.int64)
            else:
                total += part
    if now is not None:
        yield row()


def shingle_counts(bodies: DataFrame, width: int, slots: int) -> np.ndarray:
    """Estimated counts by slot over all rows."""
    parts = bodies.mapInArrow(_counter(width, slots), "slot long, counts binary")
    merged = parts.repartition("slot").sortWithinPartitions("slot").mapInArrow(_summed, "slot long, counts binary")
    sketch = np.zeros(slots, np.uint8)
    for row in merged.collect():
        sketch[row["slot"] : row["slot"] + SLOT_BLOCK] = np.frombuffer(zlib.decompress(bytes(row["counts"])), np.uint8)
    return sketch


def adaptive_prefix(tokens: np.ndarray, sketch: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, int, np.ndarray]:
    """The shingles of the prefix with the least estimated cost, in the global order; the length of the shortest prefix; their counts."""
    counts = sketch[_slots(tokens, len(sketch))]
    extra = np.maximum(counts - (noise + 2 * math.sqrt(noise) + 1), 0.0)
    order = np.lexsort((tokens, np.log2(1 + extra).astype(np.int8)))
    base = len(tokens) - least_overlap(len(tokens), percent) + 1
    most = len(tokens) - base + 1
    others = np.cumsum(extra[order[: base + most - 1]])
    matches = np.arange(1, most + 1)
    cost = SCAN_COST * (base + matches - 1) + PAIR_COST * others[base - 1 :] / matches
    order = order[: base + int(cost.argmin())]
    return tokens[order], base, counts[order]


def brief(tokens: np.ndarray) -> bytes:
    """The top 24 bits of each shingle, sorted."""
    return np.sort(tokens >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unfolded(packed: bytes) -> np.ndarray:
    """What ``brief`` kept, the repeats of a value told apart: common values are then never fewer than common shingles."""
    parts = np.zeros((len(packed) // 3, 4), np.uint8)
    parts[:, :3] = np.frombuffer(packed, np.uint8).reshape(-1, 3)
    values = parts.view("<u4").ravel().astype(np.int64)
    repeat = np.arange(len(values)) - np.searchsorted(values, values)
    return values + (repeat << 24)


_SIGNATURE = "doc_id long, n long, key binary, heads array<long>, base array<long>, frequent array<long>, matches long, counted binary"


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays).view(np.int64)))


def _signer(width: int, percent: int, shared, frequent: int):
    def sign(batches):
        at_work("shingles")
        sketch, noise = shared.value
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            if not sets:
                continue
            prefixes = [adaptive_prefix(s, sketch, noise, percent) if len(s) else (s, 0, s) for s in sets]
            common = [counts[:base] >= frequent for _, base, counts in prefixes]
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                _lists([np.array([(s * m).min() for m in (_FIRST, _SECOND, _MIX[0])]) if len(s) else s for s in sets]),
                _lists([p[:base][~often] for (p, base, _), often in zip(prefixes, common, strict=True)]),
                _lists([p[:base][often] for (p, base, _), often in zip(prefixes, common, strict=True)]),
                pa.array([len(p) - base + 1 for p, base, _ in prefixes], pa.int64()),
                pa.array([brief(p) for p, _, _ in prefixes], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "key", "heads", "base", "frequent", "matches", "counted"])

    return sign


@F.arrow_udf(BinaryType())
def _squeezed(bodies: pa.Array) -> pa.Array:
    squeeze = zstandard.ZstdCompressor().compress
    return pa.array([squeeze(x.as_py()) for x in bodies], pa.binary())


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows ``x, y`` of ``pairs`` whose texts' shingle sets are similar enough.

    Bodies travel compressed, and those alone that a pair names.  A hub ``x`` of many pairs meets them in
    several tasks, ``BODIES_BY_HUB`` in each or so.
    """
    pairs = checkpointed(pairs)
    named = pairs.select(F.col("x").alias("doc_id")).unionByName(pairs.select(F.col("y").alias("doc_id"))).distinct()
    asked = marked(docs.select("doc_id", "body"), checkpointed(named), F.col("doc_id")).filter("_marked")
    bodies = asked.select("doc_id", _squeezed("body").alias("body"))

    def check(batches):
        at_work("shingles")
        at, held, plain = None, None, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keep = []
            others = shingle_sets([plain(y.as_py()) for y in batch.column(3)], width)
            for x, x_body, other in zip(batch.column(0).to_pylist(), batch.column(2), others, strict=True):
                body = x_body.as_py()
                if at != (x, body):
                    at, held = (x, body), shingle_sets([plain(body)], width)[0]
                common = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(held) + len(other) - common) and common > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(keep, pa.bool_()))

    hubs = checkpointed(pairs.groupBy("x").agg(F.count(F.lit(1)).alias("size")).select("x", F.expr(f"size div {BODIES_BY_HUB} + 1").alias("parts")))
    large = hubs.filter("parts > 1")
    large = F.broadcast(large) if large.limit(BROADCAST_HUBS + 1).count() <= BROADCAST_HUBS else large
    dealt = pairs.join(large, "x", "left").select("x", "y", F.pmod(F.xxhash64("y"), F.coalesce("parts", F.lit(1))).alias("part"))
    second = dealt.join(bodies.select(F.col("doc_id").alias("y"), F.col("body").alias("y_body")), "y")
    first = hubs.join(bodies.select(F.col("doc_id").alias("x"), F.col("body").alias("x_body")), "x")
    first = first.select("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "x_body")
    both = second.join(first, ["x", "part"]).select("x", "y", "x_body", "y_body")
    return both.mapInArrow(check, "x long, y long")


def similar_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark = docs.sparkSession
    bodies = texts(docs).select("doc_id", F.col("text").cast("binary").alias("body"))
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << (max(1, docs.count()) * SLOTS_PER_ROW - 1).bit_length()))
    path = shared_dir(spark, "shingles")
    with small_batches(spark):
        sketch = shingle_counts(bodies.select("body"), width, slots)
        shared = spark.sparkContext.broadcast((sketch, float(sketch.mean())))
        bodies.mapInArrow(_signer(width, percent, shared, FREQUENT), _SIGNATURE).write.parquet(path)
    shared.destroy()
    signed = spark.read.schema(_SIGNATURE).parquet(path)

    full = signed.filter("n > 0")
    classes = checkpointed(full.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("heads").alias("heads")))
    nodes = classes.filter("rep is not null")
    named = bodies.filter("doc_id is not null")
    with small_batches(spark):
        near = checkpointed(connected_components(verified(_head_pairs(nodes), named, width, percent)))
        links = verified(_prefix_pairs(nodes, full.filter("doc_id is not null"), near, percent), named, width, percent)
        for end in ("x", "y"):
            of = near.select(F.col("node").alias(end), "component")
            links = links.join(of, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
        far = connected_components(links)

    label = F.coalesce("near", "rep")
    reps = classes.select("key", "rep").join(near.select(F.col("node").alias("rep"), F.col("component").alias("near")), "rep", "left").withColumn("label", label)
    reps = reps.join(far.select(F.col("node").alias("label"), F.col("component").alias("far")), "label", "left").select("key", F.coalesce("far", "label").alias("component_id"))
    whole = full.select("doc_id", F.col("n").alias("n_shingles"), "key").join(reps, "key", "left").drop("key")
    empty = signed.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out = checkpointed(whole.unionByName(empty))
    remove_tree(spark, path)
    return out


def _head_pairs(nodes: DataFrame) -> DataFrame:
    """Each class with the smallest class that has the same minimum hash: at most ``HEADS`` pairs a class.

    The hubs are written first, so that both sides of the join are dealt for it and a head with very many classes can be split.
    """
    heads = nodes.select("rep", F.posexplode("heads").alias("i", "head"))
    hubs = heads.groupBy("i", "head").agg(F.min("rep").alias("x"), F.max("rep").alias("last")).filter("x <> last").drop("last")
    return heads.join(checkpointed(hubs), ["i", "head"]).filter("rep <> x").select("x", F.col("rep").alias("y")).distinct()


def _block_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``a`` has in common with each of ``b``: incidence matrices, some columns at a time."""
    vocabulary, at, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    counts = np.zeros((len(a), len(b)), np.float32)
    repeated = times > 1
    width = min(VOCABULARY_BLOCK, int(repeated.sum()))
    place = np.where(repeated, np.cumsum(repeated) - 1, -1)[at]
    for start in range(0, int(repeated.sum()), VOCABULARY_BLOCK):
        here = (place >= start) & (place < start + VOCABULARY_BLOCK)
        matrix = np.zeros((len(a) + len(b), width), np.float32)
        matrix[rows[here], place[here] - start] = 1
        counts += matrix[: len(a)] @ matrix[len(a) :].T
    return counts


def bucket_pairs(rep, label, n, matches, prefixes: list, percent: int, earlier: list | None = None, side=None):
    """``(x, y)`` arrays of the candidates among the documents that meet at one token, but for those that share a token of ``earlier``.

    With ``side`` only documents of two sides make a pair.  Of a set's first ``n - least + m`` shingles at
    most ``n - overlap`` are missing from the other set.
    """
    order = np.argsort(n, kind="stable")
    rep, label, n, matches, prefixes = rep[order], label[order], n[order], matches[order], [prefixes[i] for i in order]
    earlier = [earlier[i] for i in order] if earlier else None
    side = None if side is None else side[order]
    spare = matches - least_overlap(n, percent)
    for i in range(0, len(rep), PAIR_BLOCK):
        a = slice(i, i + PAIR_BLOCK)
        for j in range(i, len(rep), PAIR_BLOCK):
            b = slice(j, j + PAIR_BLOCK)
            if 100 * n[a][-1] < percent * n[b][0]:
                break
            likely = (label[a][:, None] != label[b]) & (100 * n[a][:, None] >= percent * n[b])
            if side is not None:
                likely &= side[a][:, None] != side[b]
            if i == j:
                likely &= np.triu(np.ones(likely.shape, bool), 1)
            asked = -(-percent * (n[a][:, None] + n[b]) // (100 + percent)) + np.minimum(spare[a][:, None], spare[b])
            if (likely & (asked > 1)).any():
                likely &= (asked <= 1) | (_block_counts(prefixes[a], prefixes[b]) >= asked)
            if earlier and likely.any():
                likely &= _block_counts(earlier[a], earlier[b]) == 0
            x, y = np.nonzero(likely)
            if len(x):
                x, y = rep[a][x], rep[b][y]
                yield np.minimum(x, y), np.maximum(x, y)


def _pairer(percent: int):
    """Rows come sorted by token and pair of blocks; those of one pair are held at a time, twice ``PAIR_BLOCK`` or so."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def pairs():
            rows = pa.Table.from_batches(held).combine_chunks()
            if len(rows) < 2:
                return
            token, low, high, block, rep, label, n, matches = (
                rows.column(c).to_numpy() for c in ("token", "low", "high", "block", "rep", "label", "n", "matches")
            )
            prefixes = [unfolded(x.as_py()) for x in rows.column("counted")]
            tokens = (x.values.to_numpy() for x in rows.column("tokens"))
            earlier = [x[x < token[0]] for x in tokens]
            side = None if low[0] == high[0] else block
            for x, y in bucket_pairs(rep, label, n, matches, prefixes, percent, earlier, side):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])

        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and tuple(keys[a]) != last:
                    yield from pairs()
                    held = []
                last = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from pairs()

    return run


def _labelled(nodes: DataFrame, signed: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``signed`` that stand for their class, with ``rep`` and ``label``; and those rows in two, as few as can be joined.

    Most documents stand for themselves under their own name.  The others (members of a class or a
    component, identifiers with several rows) are marked in a bitmap, and they alone meet ``near`` in a join.
    """
    ids = signed.select("doc_id", "key")
    members = ids.join(nodes.select("key", F.col("rep").alias("doc_id")), ["doc_id", "key"], "left_anti").select("doc_id")
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id")
    unlike = checkpointed(members.unionByName(several).unionByName(near.select(F.col("node").alias("doc_id"))).distinct())
    known = nodes.select("rep", "key").join(near.select(F.col("node").alias("rep"), F.col("component").alias("label")), "rep", "left")
    known = known.withColumn("label", F.coalesce("label", "rep"))
    of = marked(signed.withColumnRenamed("doc_id", "rep"), unlike, F.col("rep"))
    plain = of.filter("not _marked").withColumn("label", F.col("rep"))
    joined = of.filter("_marked").join(known, ["rep", "key"]).dropDuplicates(["rep", "key"])
    return plain, joined


def _prefix_pairs(nodes: DataFrame, signed: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs in different components that meet at a token of their shortest prefixes.

    Tokens below ``FREQUENT`` in the sketch have few rows, one shuffle finds those with two labels.  For
    the others labels are aggregated before the shuffle and the rows come by a join that can be split.
    The documents of a token are dealt into blocks, and every pair of blocks is a group of its own.
    """
    plain, joined = _labelled(nodes, signed, near)

    def met(column: str) -> DataFrame:
        parts = (x.select("rep", "label", F.explode(column).alias("token")) for x in (plain, joined))
        return next(parts).unionByName(next(parts))

    over = Window.partitionBy("token")
    rare = met("base").withColumn("low", F.min("label").over(over)).withColumn("high", F.max("label").over(over))
    often = met("frequent")
    mixed = checkpointed(often.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token"))
    shared = rare.filter("low <> high").select("rep", "label", "token").unionByName(often.join(mixed, "token").select("rep", "label", "token"))
    shared = checkpointed(shared)
    total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
    members = shared.groupBy("token").agg(F.count(F.lit(1)).alias("size"), total("rep").alias("one"), total(F.lit(1), "rep").alias("two"))
    apart = members.groupBy("size", "one", "two").agg(F.min("token").alias("token"))
    apart = apart.select("token", F.expr(f"(size - 1) div {PAIR_BLOCK} + 1").alias("blocks"))
    placed = shared.join(apart, "token").groupBy("rep", "label").agg(F.collect_set(F.struct("token", "blocks")).alias("at"))
    placed = checkpointed(placed.select(F.col("rep").alias("doc_id"), "label", "at"))
    longer = marked(signed.select("doc_id", "key", "n", "matches", "counted"), placed.select("doc_id").distinct(), F.col("doc_id"))
    longer = longer.filter("_marked").drop("_marked")
    longer = longer.join(nodes.select(F.col("rep").alias("doc_id"), "key"), ["doc_id", "key"]).drop("key")
    rows = placed.join(longer, "doc_id").select(
        F.col("doc_id").alias("rep"), "label", "n", "matches", "counted", F.col("at.token").alias("tokens"), F.explode("at").alias("at")
    )
    block = F.pmod(F.xxhash64("rep"), F.col("at.blocks"))
    rows = rows.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("at.blocks") - 1)))
    rows = rows.select(
        F.col("at.token").alias("token"), F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
        "block", "rep", "label", "n", "matches", "tokens", "counted",
    )
    keys = ("token", "low", "high")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_pairer(percent), "x long, y long")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the document of smallest ``doc_id`` of each group of similar ones; rows without a ``doc_id`` stay.

    Rows that repeat the ``doc_id`` that stays are one document, and all of them stay.  Only rows that a
    bitmap of the dropped identifiers marks are shuffled, to be confirmed.
    """
    groups = similar_groups(docs, width, percent)
    gone = checkpointed(groups.filter("doc_id <> component_id").select("doc_id").distinct())
    rows = marked(docs, gone, F.col("doc_id"))
    doubtful = rows.filter("_marked").join(gone.select(F.col("doc_id").alias("gone_id")), F.col("doc_id") == F.col("gone_id"), "left_anti")
    return rows.filter("not _marked").unionByName(doubtful).select(*docs.columns)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir), width=4, percent=85)
