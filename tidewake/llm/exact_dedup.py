"""Exact deduplication: compressed radix tries own the texts of one length-and-hash partition.

Map tasks first collapse equal texts in a bounded buffer, so a text that fills a third of the
table leaves each task once a buffer.  The collapsed rows are dealt by length and SHA-256; every
partition inserts the full byte strings into a Patricia trie whose terminal nodes keep the owner
(largest or smallest identifier) and the group's size.  A trie that outgrows its budget spills its
largest subtree to the task's temporary folder and takes it up again at the end.  One small row per
distinct text goes back to the documents by a join on the digest, where AQE may split a hot digest.

Edge cases: null text is empty text; null identifiers never own a group that has another; in a group
of null identifiers alone every row is kept; rows that repeat one ``doc_id`` and text count in the
size and share the verdict; an empty table gives an empty result; very long texts are compared whole; of a
table's columns ``doc_id`` and ``text`` alone are read, others may have any name.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import documents, texts

COLLAPSE_BYTES = 32 << 20
TRIE_BYTES = 128 << 20
_NODE_BYTES = 200
_GROUP = "digest binary, n_bytes long, keep_id long, group_size long"


class Terminal:
    """The owner of one text and how many rows hold it."""

    __slots__ = ("digest", "owner", "size")

    def __init__(self, digest: bytes):
        self.digest, self.owner, self.size = digest, None, 0

    def add(self, owner: int | None, size: int, largest: bool) -> None:
        self.size += size
        if owner is not None and (self.owner is None or (owner > self.owner if largest else owner < self.owner)):
            self.owner = owner


class Node:
    __slots__ = ("children", "edge", "terminal")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.terminal = edge, {}, None


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class PatriciaTrie:
    """Byte strings to terminals, within ``budget`` bytes; ``drain`` yields every text's terminal once."""

    def __init__(self, budget: int = TRIE_BYTES, largest: bool = True):
        self.root, self.budget, self.used, self.largest = Node(b""), budget, 0, largest
        self.spilled: dict[bytes, tuple[str, object]] = {}

    def insert(self, text: bytes, digest: bytes, owner: int | None, size: int) -> None:
        for prefix, (_, out) in self.spilled.items():
            if text.startswith(prefix):
                self._append(out, text, digest, owner, size)
                return
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.used += _NODE_BYTES + len(child.edge)
                node, at = child, len(text)
                break
            if text.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
                continue
            cut = _common(child.edge, text[at : at + len(child.edge)])
            upper = Node(child.edge[:cut])
            child.edge = child.edge[cut:]
            upper.children[child.edge[0]] = child
            node.children[text[at]] = upper
            self.used += _NODE_BYTES
            node, at = upper, at + cut
        if node.terminal is None:
            node.terminal = Terminal(digest)
        elif node.terminal.digest != digest:
            raise ValueError("equal bytes under two digests")
        node.terminal.add(owner, size, self.largest)
        if self.used > self.budget:
            self._spill()

    def _walk(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, Terminal]]:
        stack = [(node, prefix)]
        while stack:
            node, path = stack.pop()
            if node.terminal is not None:
                yield path, node.terminal
            stack += [(child, path + child.edge) for child in node.children.values()]

    @staticmethod
    def _weight(node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += _NODE_BYTES + len(node.edge)
            stack += node.children.values()
        return total

    def _spill(self) -> None:
        """Write out the heaviest subtree below the first branching; later texts of its prefix follow it."""
        parent, path = self.root, b""
        while len(parent.children) == 1:
            only = next(iter(parent.children.values()))
            if not only.children:
                return
            parent, path = only, path + only.edge
        if not parent.children:
            return
        first, child = max(parent.children.items(), key=lambda x: self._weight(x[1]))
        del parent.children[first]
        self.used -= self._weight(child)
        handle, name = tempfile.mkstemp(prefix="subtree-")
        out = os.fdopen(handle, "wb")
        self.spilled[path + bytes([first])] = (name, out)
        for text, t in self._walk(child, path + child.edge):
            self._append(out, text, t.digest, t.owner, t.size)

    @staticmethod
    def _append(out, text: bytes, digest: bytes, owner: int | None, size: int) -> None:
        out.write(struct.pack("<q?qq32s", len(text), owner is not None, owner or 0, size, digest) + text)

    def drain(self) -> Iterator[tuple[int, Terminal]]:
        """``(length in bytes, terminal)`` of everything inserted; takes spilled subtrees up one by one."""
        try:
            for text, t in self._walk(self.root, b""):
                yield len(text), t
            self.root, self.used = Node(b""), 0
            for name, out in self.spilled.values():
                out.close()
                deeper = PatriciaTrie(self.budget, self.largest)
                with open(name, "rb") as back:
                    width = struct.calcsize("<q?qq32s")
                    while head := back.read(width):
                        length, known, owner, size, digest = struct.unpack("<q?qq32s", head)
                        deeper.insert(back.read(length), digest, owner if known else None, size)
                os.remove(name)
                yield from deeper.drain()
        finally:
            for name, out in self.spilled.values():
                out.close()
                if os.path.exists(name):
                    os.remove(name)


def _collapser(largest: bool):
    def collapse(batches):
        held: dict[bytes, Terminal] = {}
        used = 0

        def rows():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([len(t) for t in held], pa.int64()),
                    pa.array([x.digest for x in held.values()], pa.binary()),
                    pa.array(list(held), pa.binary()),
                    pa.array([x.owner for x in held.values()], pa.int64()),
                    pa.array([x.size for x in held.values()], pa.int64()),
                ],
                ["n_bytes", "digest", "body", "owner", "size"],
            )

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = body.as_py()
                entry = held.get(body)
                if entry is None:
                    entry = held[body] = Terminal(hashlib.sha256(body).digest())
                    used += len(body)
                entry.add(doc_id, 1, largest)
                if used > COLLAPSE_BYTES:
                    yield rows()
                    held, used = {}, 0
        if held:
            yield rows()

    return collapse


def _owner(largest: bool, budget: int):
    def own(batches):
        trie = PatriciaTrie(budget, largest)
        for batch in batches:
            for digest, body, owner, size in zip(batch.column(1), batch.column(2), batch.column(3), batch.column(4), strict=True):
                trie.insert(body.as_py(), digest.as_py(), owner.as_py(), size.as_py())
        held = []

        def rows():
            columns = list(zip(*held, strict=True))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["digest", "n_bytes", "keep_id", "group_size"])

        for length, t in trie.drain():
            held.append((t.digest, length, t.owner, t.size))
            if len(held) == 10_000:
                yield rows()
                held = []
        if held:
            yield rows()

    return own


def text_groups(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: ``digest, n_bytes, keep_id, group_size``."""
    largest = {"largest": True, "smallest": False}[keep]
    bodies = texts(docs).select("doc_id", F.col("text").cast("binary").alias("body"))
    collapsed = bodies.mapInArrow(_collapser(largest), "n_bytes long, digest binary, body binary, owner long, size long")
    return collapsed.repartition("n_bytes", "digest").mapInArrow(_owner(largest, trie_bytes), _GROUP)


def exact_duplicates(docs: DataFrame, keep: str = "largest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    groups = text_groups(docs, keep, trie_bytes).select("digest", "keep_id", "group_size")
    rows = texts(docs).select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    return rows.join(groups.repartition("digest"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
