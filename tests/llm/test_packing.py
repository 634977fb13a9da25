import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewake.llm import packing, queries

from .conftest import SF


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def check(rows, texts, tokenizer):
    """``texts`` by the order of their identifiers, repeated and null ones included."""
    want = collections.Counter()
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), packing.CAPACITY):
            part = ids[start : start + packing.CAPACITY]
            want[doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sum(r["length"] for r in rows) / (len(by) * packing.CAPACITY)


def test_query(spark, table, tokenizer):
    rows = queries.QUERIES["op1_packing"](spark, SF).collect()
    assert check(rows, table.items(), tokenizer) > 0.95


def test_odd_rows_and_empty_table(odd, odd_rows, nothing, tokenizer):
    check(packing.packed_documents(odd).collect(), [(r[0], r[1] or "") for r in odd_rows], tokenizer)
    assert packing.packed_documents(nothing).collect() == []


def test_words_encode_as_the_library_does(tokenizer):
    words = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    for x in range(1, 0x3100):
        c = chr(x)
        text = f"a{c} b{c}{c}c1 {c} Ab{c}.# 'S{c}"
        got = np.frombuffer(words.encode(text.encode()), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, hex(x)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|> x", " <|startoftext|> hi <|endoftext|>", "<|start<|endoftext|>", "<|endoftext|><|endoftext|>!", "<|endoftext|", "Ä<|startoftext|>'s"])
def test_special_tokens_as_the_library_has_them(tokenizer, text):
    words = packing.WordIds(public_tokenizers.path(packing.VOCABULARY))
    assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_kept_on_request(spark):
    rows = spark.createDataFrame([(1, np.arange(5000, dtype="<u4").tobytes()), (2, b""), (3, np.arange(7, dtype="<u4").tobytes())], "doc_id long, body binary")
    out = packing.pack(rows, capacity=2048, open_windows=2).collect()
    whole = b"".join(bytes(r["ids"]) for r in sorted((r for r in out if r["doc_id"] == 1), key=lambda r: r["start"]))
    assert whole == np.arange(5000, dtype="<u4").tobytes() and {r["doc_id"] for r in out} == {1, 3}


def test_best_fit_and_emission():
    w = packing.Windows(10, 2)
    assert w.place(6, "a") is None and w.place(5, "b") is None
    assert w.place(4, "c") is None and w.place(7, "d") == ["a", "c"]
    assert sorted(map(len, w.held)) == [1, 1]
