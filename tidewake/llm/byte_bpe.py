"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

Texts are cut by the vocabulary's pattern; the pieces that a worker has not met yet are encoded
together.  Pieces of similar length form one padded matrix of token ids next to a matrix with the
rank of every adjacent pair.  In each round every row merges its leftmost pair of minimum rank,
ranks around the merge are looked up in an open-addressing hash table, the row is compacted, and rows
without a mergeable pair leave the matrix.  Pieces over ``LONG`` bytes (a wall of one character class)
are matrices of one row, which merges all pairs of its minimum rank in a round, from the left as far as
none of them brings a pair of a lower rank: the same merges in the same order, in fewer rounds.

Edge cases: null text is empty and gives no ids; empty tables give empty results; texts are encoded
whole whatever their length; repeated rows are encoded each; equal ranks merge from the left; only the
named columns are read.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import documents, texts

RANKS = "byte_bpe_50k.tiktoken"
LONG = 512
CACHED_PIECES = 300_000
CHARS_AT_ONCE = 1 << 20
IDS_AT_ONCE = 1 << 18
_NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: What the public pattern means on texts below U+0250, in a form that the faster engine runs.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
_LATIN = re.compile(rf" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BEYOND = re.compile("[\\x1c-\\x1f\u0250-\U0010ffff]")


class PairTable:
    """``(left id, right id)`` to the id of their merge: open addressing, probed for whole arrays at once."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(4, (2 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, _EMPTY), np.full(1 << bits, _NONE, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.uint64)
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = keys * _FACTOR >> self.shift
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[at] == _EMPTY
            slots, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slots], self.values[slots] = keys[won], values[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, values, at = keys[left], values[left], at[left] + np.uint64(1) & self.mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merges, ``_NONE`` where a pair does not merge or holds padding."""
        keys = left.astype(np.int64).view(np.uint64) << np.uint64(32) | (right.astype(np.int64).view(np.uint64) & np.uint64(0xFFFFFFFF))
        at = keys * _FACTOR >> self.shift
        out = np.full(keys.shape, _NONE, np.int32)
        flat_keys, flat_at, flat_out = keys.ravel(), at.ravel(), out.ravel()
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        for _ in range(self.probes):
            slot = flat_at[todo]
            held = self.keys[slot]
            same = held == flat_keys[todo]
            flat_out[todo[same]] = self.values[slot[same]]
            todo = todo[~same & (held != _EMPTY)]
            if not len(todo):
                break
            flat_at[todo] = flat_at[todo] + np.uint64(1) & self.mask
        return out


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.latin = pattern == public_tokenizers.PATTERN
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.table = PairTable(pairs)
        self.cache: dict[str, bytes] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece, in order."""
        return [np.frombuffer(x, np.int32) for x in self._coded(pieces)]

    def _coded(self, pieces: list[bytes]) -> list[bytes]:
        """The same as the bytes of the ids."""
        out = [b""] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = 1
        while width <= LONG:
            rows = np.flatnonzero((sizes > width // 2) & (sizes <= width))
            for part in np.array_split(rows, -(-len(rows) * width // (1 << 20))) if len(rows) else ():
                self._bucket(pieces, part, width, out)
            width *= 2
        for i in np.flatnonzero(sizes > LONG):
            out[i] = self._row(pieces[i]).tobytes()
        return out

    def _bucket(self, pieces, rows, width, out) -> None:
        sizes = np.fromiter((len(pieces[i]) for i in rows), np.int64, len(rows))
        here = np.arange(width)
        ids = np.full((len(rows), width), -1, np.int32)
        ids[here < sizes[:, None]] = self.single[np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)]
        if width == 1:
            self._keep(rows, ids, sizes, out)
            return
        rank = self.table(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            ended = best == _NONE
            if ended.any():
                self._keep(rows[ended], ids[ended], sizes[ended], out)
                going = ~ended
                rows, ids, rank, sizes, at, best = (x[going] for x in (rows, ids, rank, sizes, at, best))
                if not len(rows):
                    return
            every = np.arange(len(rows))
            ids[every, at] = best
            ids = self._closed_up(ids, at + 1, -1)
            rank = self._closed_up(rank, at, _NONE)
            sizes = sizes - 1
            most = int(sizes.max())
            ids, rank = ids[:, : max(most, 2)], rank[:, : max(most - 1, 1)]
            inner = at < rank.shape[1]
            rank[every[inner], at[inner]] = self.table(ids[every[inner], at[inner]], ids[every[inner], at[inner] + 1])
            before = at > 0
            rank[every[before], at[before] - 1] = self.table(ids[every[before], at[before] - 1], ids[every[before], at[before]])

    @staticmethod
    def _keep(rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray, out: list[bytes]) -> None:
        """The first ids of each row of a matrix, cut from its bytes."""
        whole, starts = ids.tobytes(), np.arange(len(rows)) * (4 * ids.shape[1])
        for i, start, end in zip(rows.tolist(), starts.tolist(), (starts + 4 * sizes).tolist(), strict=True):
            out[i] = whole[start:end]

    @staticmethod
    def _closed_up(matrix: np.ndarray, gone: np.ndarray, pad) -> np.ndarray:
        """Each row without its element ``gone``, padded at the end."""
        width = matrix.shape[1]
        keep = np.arange(width) != gone[:, None]
        closed = np.full_like(matrix, pad)
        closed[:, : width - 1] = matrix[keep].reshape(len(matrix), width - 1)
        return closed

    def _row(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, np.uint8)]
        rank = self.table(ids[:-1], ids[1:])
        while len(rank) and (best := rank.min()) != _NONE:
            at = np.flatnonzero(rank == best)
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            # What each merge brings while those to its right are still to come; a lower rank goes first.
            padded = np.append(ids, [-1, -1]).astype(np.int32)
            before = np.where(np.diff(at, prepend=-2) == 2, best, padded[at - 1])
            new = np.full(len(at), best, np.int32)
            early = np.flatnonzero(np.minimum(self.table(before, new), self.table(new, padded[at + 2])) < best)
            if len(early):
                at = at[: early[0] + 1]
            ids = ids.copy()
            ids[at] = best
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, rank = ids[keep], np.append(rank, _NONE)[keep][:-1]
            at = at - np.arange(len(at))
            ahead, behind = at[at < len(rank)], at[at > 0] - 1
            rank[ahead] = self.table(ids[ahead], ids[ahead + 1])
            rank[behind] = self.table(ids[behind], ids[behind + 1])
        return ids

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of each text; so many texts at a time that their pieces stay small."""
        out, start, held = [], 0, 0
        for i, text in enumerate(batch):
            held += len(text)
            if held > CHARS_AT_ONCE or i == len(batch) - 1:
                out += self._encode(batch[start : i + 1])
                start, held = i + 1, 0
        return out

    def _encode(self, batch: list[str]) -> list[np.ndarray]:
        cut = [(_LATIN if self.latin and not _BEYOND.search(text) else self.pattern).findall(text) for text in batch]
        met: set[str] = set().union(*cut)
        new = met.difference(self.cache)
        if len(new) + len(self.cache) > CACHED_PIECES:
            self.cache.clear()
            new = met
        listed = list(new)
        self.cache.update(zip(listed, self._coded([p.encode() for p in listed]), strict=True))
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), np.int32) for pieces in cut]


def _by_id(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def _read(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    """The vocabulary of a rank file, once per worker."""
    return ByteBPE(_read(path), pattern)


@functools.lru_cache(maxsize=2)
def load_tokens(path: str) -> list[bytes]:
    """The bytes of each id, once per worker."""
    return _by_id(_read(path))


@functools.lru_cache(maxsize=2)
def load_bytes(path: str) -> Bytes:
    return Bytes(load_tokens(path))


def decode(tokens: list[bytes], ids) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


class Bytes:
    """The bytes of all ids in one array, so that many texts are decoded by one look-up."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = self.sizes.cumsum() - self.sizes

    def __call__(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of ``ids``, and where each id's bytes end."""
        sizes = self.sizes[ids]
        ends = sizes.cumsum()
        place = np.repeat(self.starts[ids] - ends + sizes, sizes)
        place += np.arange(len(place))
        return self.flat[place].tobytes(), ends

    def texts(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Texts of ``sizes`` ids each; so many at a time that the look-up stays small."""
        out, start, row, ends = [], 0, 0, sizes.cumsum()
        while row < len(sizes):
            last = max(row + 1, int(np.searchsorted(ends, start + IDS_AT_ONCE, "right")))
            whole, at = self(ids[start : ends[last - 1]])
            cuts = np.append(0, at)[np.append(start, ends[row:last]) - start].tolist()
            out += [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            start, row = int(ends[last - 1]), last
        return out


def encode_texts(rows: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``rows`` with a column ``ids``."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        found = load(path, pattern).encode(["" if x is None else x for x in column.to_pylist()])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.empty(0, np.int32)])))

    return rows.withColumn("ids", encode(text))


def decode_ids(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with a binary column ``decoded``."""

    @F.arrow_udf("binary")
    def to_bytes(column: pa.Array) -> pa.Array:
        flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
        return pa.array(load_bytes(path).texts(flat, sizes), pa.binary())

    return rows.withColumn("decoded", to_bytes(ids))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    rows = decode_ids(encode_texts(texts(documents(spark, sf_dir)), path, pattern), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
