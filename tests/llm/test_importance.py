"""The draw against a plain reading of its definition."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from tidewake.llm import importance

from .conftest import SF


def brute_features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=25, least=20, longest=2, buckets=10_000, seed=7):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for table, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in brute_features(text, longest)[1]:
                table[place(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)] if buckets < 100_000 else None
    out = []
    for doc_id, text in docs:
        n, found = brute_features(text, longest)
        weight = sum(gain[place(f)] for f in found) // len(found) if found else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), n, weight, score, None])
    able = sorted((r for r in out if r[2] >= least and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for i, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = i + 1
    return out


def _key(r):
    return tuple((x is None, x or 0) for x in r)


def _same(got, want):
    got = sorted((tuple(r) for r in got), key=_key)
    assert got == sorted((tuple(r) for r in want), key=_key)
    return got


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = importance.op12_importance_resampling(spark, SF)
    _same(got.select("doc_id", "n_features", "n_words", "weight", "score", "rank").collect(), brute(docs, target))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_odd_rows(spark, odd, odd_rows, monkeypatch, longest):
    monkeypatch.setattr(importance, "PIECE_BYTES", 64)
    monkeypatch.setattr(importance, "WALK_WORDS", 50)
    monkeypatch.setattr(importance, "MAX_NODES", 40)
    target = spark.createDataFrame([(1, "two words one two three"), (2, None), (3, "")], "item_id long, text string")
    rows = [(r[0], r[1]) for r in odd_rows]
    got = importance.resampled(odd, target, percent=50, least_words=2, longest=longest).collect()
    # Rows repeated under one doc_id take neighbouring ranks in either order.
    _same(got, brute(rows, ["two words one two three", None, ""], 50, 2, longest))


def test_empty_tables(spark, nothing, odd, odd_rows):
    assert importance.resampled(nothing, odd).collect() == []
    _same(importance.resampled(odd, nothing).collect(), brute([(r[0], r[1]) for r in odd_rows], []))


def test_pieces_keep_words_whole(monkeypatch):
    monkeypatch.setattr(importance, "PIECE_BYTES", 7)
    text = ("ab cdé fghijklmnop " * 5 + "x" * 700 + " y").encode()
    for longest in (1, 2, 4):
        words = [w for found, lead in importance.pieces(text, longest) for w in found[lead:]]
        assert words == text.split()


def test_nodes_continue_their_parents_crc():
    trie = importance.WordTrie()
    trie.add([b"a", b"b", b"a", b"b"], np.zeros(4, np.int64), np.zeros(4, bool))
    first, second = trie.levels
    node = second.numbers[first.numbers[b"a"] << 32 | first.numbers[b"b"]]
    assert second.crc[node] == zlib.crc32(b"a b") and second.count[node] == 2
    trie.spill()
    assert trie.totals.sum() == 7 and trie.totals[zlib.crc32(b"a b") % importance.BUCKETS] >= 2 and not len(trie)
