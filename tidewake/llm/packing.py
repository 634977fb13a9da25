"""Packing token sequences into fixed windows with bounded space.

Each task keeps a fixed number of open windows.  Whole windows are cut off long documents; what
remains goes to the open window it fits best, and when it fits none, the fullest window is emitted
and a fresh one opened.  What is still open at the end of a task is written with the rest, and the
leftovers of all tasks are merged by the same rule, longest first, in as many tasks as their number
asks for.  A piece once cut is never cut again, so its checksum stays valid.

Strings of special tokens in a text get their own ids, as the library gives them.

Edge cases: null text is empty and packs as the end id alone; a null ``doc_id`` is carried along;
repeated rows are packed each on its own; an empty table gives no pieces; a very long text is encoded
some words at a time and cut into whole sequences; of windows with equal space the first takes a piece,
and leftovers of one length merge in the order of ``doc_id`` and ``start``; of a table's columns
``doc_id`` and ``text`` alone are read, others may have any name.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewake.llm.common import at_work, documents, shared_dir, small_batches, texts

VOCABULARY = "word_bpe_49k.json"
END_ID, CAPACITY, OPEN_WINDOWS = 1, 2048, 64
MERGED_WINDOWS = 4096
CACHED_WORDS, WORDS_AT_ONCE = 400_000, 50_000
_TRAILING = b".,;:!?#%&*$|()[]"
#: Words that the normaliser and the splitter leave as they are; they go to the merges straight away.
_PLAIN = re.compile("[a-zà-öø-ÿ]+")
_FIXED = re.compile("[0-9a-zà-öø-ÿ]")
#: The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 on.
_KEPT = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _KEPT)}
_MERGED_IDS = 1 << 62


class WordIds:
    """Ids of a text word by word: the vocabulary drops white space, so words encode on their own.

    Special tokens are looked for in the raw text before anything else; a word that lower-casing makes
    equal to one is an ordinary word.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache: dict[bytes, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("an added token of this vocabulary is not plain raw text")
        self.special = {t.content.encode(): array("I", [i]).tobytes() for i, t in added.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.any_special = re.compile(b"|".join(map(re.escape, longest)) or b"(?!)")

    def _stem(self, word: bytes) -> bytes:
        """The word without trailing marks, where a letter or digit that no normalisation touches ends before them."""
        stem = word.rstrip(_TRAILING)
        return stem if stem and _FIXED.fullmatch(stem.decode()[-1]) else word

    def _learn(self, words: set[bytes]) -> None:
        split = {w: self._stem(w) for w in words}
        parts = {p for w, s in split.items() for p in (s, w[len(s) :]) if p and p not in self.cache}
        merge, plain, listed = self.tokenizer.model.tokenize, [], []
        for w in parts:
            (plain if _PLAIN.fullmatch(w.decode()) else listed).append(w)
        self.cache.update((w, array("I", [t.id for t in merge(w.decode("latin-1").translate(_BYTE_CHARS))]).tobytes()) for w in plain)
        found = self.tokenizer.encode_batch_fast([w.decode() for w in listed], add_special_tokens=False)
        self.cache.update((w, array("I", e.ids).tobytes()) for w, e in zip(listed, found, strict=True))
        self.cache.update((w, self.cache[s] + self.cache[w[len(s) :]]) for w, s in split.items() if len(s) < len(w))

    def encode(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a text, without an end id."""
        parts, at = [], 0
        for m in self.any_special.finditer(text):
            parts += [self._ordinary(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return b"".join([*parts, self._ordinary(text[at:] if at else text)])

    def _ordinary(self, text: bytes) -> bytes:
        words, parts = text.lower().split(), []
        for start in range(0, len(words), WORDS_AT_ONCE):
            some = words[start : start + WORDS_AT_ONCE]
            met = set(some)
            if new := {w for w in met if w not in self.cache}:
                if len(self.cache) + 2 * len(new) > CACHED_WORDS:
                    self.cache.clear()
                    new = met
                self._learn(new)
            parts.append(b"".join(map(self.cache.__getitem__, some)))
        return b"".join(parts)


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    """The tokenizer, once per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def encoder(path: str, end_id: int = END_ID) -> Callable[[bytes], bytes]:
    """From a text in UTF-8 to its little-endian unsigned 32-bit ids, the end id with them."""
    end = np.array([end_id], "<u4").tobytes()
    return lambda text: load(path).encode(text) + end


class Windows:
    """Open windows sorted by free space; each holds its pieces in order."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit, self.free, self.held = capacity, limit, [], []

    def place(self, length: int, piece) -> list | None:
        """Put a piece where it fits best; what had to be emitted to make room, if anything."""
        at, emitted, pieces = bisect.bisect_left(self.free, length), None, []
        left = self.capacity
        if at < len(self.free):
            left, pieces = self.free.pop(at), self.held.pop(at)
        elif len(self.free) == self.limit:
            self.free.pop(0)
            emitted = self.held.pop(0)
        pieces.append(piece)
        left -= length
        at = bisect.bisect_left(self.free, left)
        self.free.insert(at, left)
        self.held.insert(at, pieces)
        return emitted


_PLACED = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")


def _placer(capacity: int, limit: int, encode, keep_ids: bool):
    def place(batches):
        at_work("packing", load.cache_clear)
        serial = TaskContext.get().partitionId() << 32
        windows, rows = Windows(capacity, limit), []

        def close(pieces) -> None:
            nonlocal serial
            offset = 0
            for doc_id, start, length, total, *payload in pieces:
                rows.append((doc_id, start, length, total, serial, offset, *payload))
                offset += length
            serial += 1

        def flush():
            kinds = [pa.int64()] * (len(_PLACED) + 1) + [pa.binary()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
            return pa.RecordBatch.from_arrays(columns, [*_PLACED, "ids_crc32", "ids"][: len(columns)])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(ids.as_py())
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    part = ids[4 * start : 4 * (start + length)]
                    piece = (doc_id, start, length, total, zlib.crc32(part), *([part] if keep_ids else []))
                    emitted = [piece] if length == capacity else windows.place(length, piece)
                    if emitted:
                        close(emitted)
                if len(rows) >= 4096:
                    yield flush()
                    rows = []
        for pieces in windows.held:
            rows += [(doc_id, start, length, total, None, None, *payload) for doc_id, start, length, total, *payload in pieces]
        if rows:
            yield flush()

    return place


def _merger(capacity: int, limit: int):
    def merge(batches):
        serial = _MERGED_IDS | TaskContext.get().partitionId() << 32
        windows = Windows(capacity, limit)

        def close(pieces):
            nonlocal serial
            offsets = np.cumsum([0, *(length for length, _ in pieces)])[:-1]
            whole = pa.concat_arrays([pa.array([p], struct_type) for _, p in pieces])
            out = pa.RecordBatch.from_arrays([pa.array([serial] * len(pieces), pa.int64()), pa.array(offsets, pa.int64()), whole], ["sequence_id", "offset", "piece"])
            serial += 1
            return out

        struct_type = None
        for batch in batches:
            struct_type = batch.column(0).type
            for piece in batch.column(0).to_pylist():
                if emitted := windows.place(piece["length"], (piece["length"], piece)):
                    yield close(emitted)
        for pieces in windows.held:
            yield close(pieces)

    return merge


def pack(rows: DataFrame, encode: Callable[[bytes], bytes] | None = None, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, keep_ids: bool = True) -> DataFrame:
    """Pieces ``doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset``.

    ``rows`` has ``doc_id`` and a binary column ``body``: the ids as little-endian unsigned 32-bit
    numbers, or what ``encode`` makes them of.  Without ``keep_ids`` their checksum alone is stored.
    """
    spark = rows.sparkSession
    kind = ", ".join(f"{c} long" for c in (*_PLACED, "ids_crc32")) + ", ids binary" * keep_ids
    placed = rows.select("doc_id", "body").mapInArrow(_placer(capacity, open_windows, encode or bytes, keep_ids), kind)
    path = shared_dir(spark, "packing")
    with small_batches(spark):
        placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    closed, leftover = stored.filter("sequence_id is not null"), stored.filter("sequence_id is null")
    others = [c for c in stored.columns if c not in ("sequence_id", "offset")]
    space = leftover.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-space // (capacity * MERGED_WINDOWS)))
    pieces = leftover.select(F.struct(*others).alias("piece")).repartition(tasks, "piece.doc_id", "piece.start")
    pieces = pieces.sortWithinPartitions(F.col("piece.length").desc(), "piece.doc_id", "piece.start")
    kind = pieces.schema["piece"].dataType.simpleString()
    merged = pieces.mapInArrow(_merger(capacity, 2 * MERGED_WINDOWS), f"sequence_id long, offset long, piece {kind}")
    order = [*others, "sequence_id", "offset"]
    return closed.select(*order).unionByName(merged.select("piece.*", "sequence_id", "offset").select(*order))


def packed_documents(docs: DataFrame) -> DataFrame:
    """The pieces of a table of documents, with a checksum of their ids."""
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("body"))
    pieces = pack(rows, encoder(public_tokenizers.path(VOCABULARY)), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir))
