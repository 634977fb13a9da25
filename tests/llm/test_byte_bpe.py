import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewake.llm import byte_bpe, queries
from tidewake.llm.common import texts

from .conftest import SF

PATH, PATTERN = public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query(spark, table, reference):
    for r in queries.QUERIES["op8_byte_bpe"](spark, SF).collect():
        text = table[r["doc_id"]]
        ids = reference.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows_round_trip(odd, nothing, reference):
    for rows in (odd, nothing):
        coded = byte_bpe.decode_ids(byte_bpe.encode_texts(texts(rows), PATH, PATTERN), PATH)
        for r in coded.collect():
            assert list(r["ids"]) == reference.encode_ordinary(r["text"]) and bytes(r["decoded"]).decode() == r["text"]


def test_any_character_and_long_pieces(reference):
    codec, rng = byte_bpe.load(PATH, PATTERN), random.Random(3)
    some = [f"a{chr(x)} b{chr(x)}{chr(x)}c1 {chr(x)}" for x in range(1, 0x3100)]
    some += ["a" * 5000, "ab" * 1500, "日本" * 400, " " * 700 + "x", "\n" * 600, "".join(rng.choice("abcde") for _ in range(2000))]
    some += ["".join(chr(rng.choice([rng.randrange(32, 0x2FF), 32, 10, rng.randrange(0x1F300, 0x1F600)])) for _ in range(100)) for _ in range(100)]
    for text, ids in zip(some, codec.encode(some), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_cache_overflow_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 3)
    monkeypatch.setattr(byte_bpe, "CHARS_AT_ONCE", 10)
    codec = byte_bpe.ByteBPE(byte_bpe._read(PATH), PATTERN)
    some = ["some words here", "and others there", "some words there"]
    assert [x.tolist() for x in codec.encode(some)] == [reference.encode_ordinary(t) for t in some]
    assert F is not None


def test_many_texts_are_decoded_by_one_look_up(monkeypatch):
    codec, tokens = byte_bpe.load(PATH, PATTERN), byte_bpe.load_tokens(PATH)
    some = ["", "some words", "日本 \U0001f600", "", "a" * 300, "x", ""]
    found = codec.encode(some)
    for at_once in (1, 7, 1 << 18):
        monkeypatch.setattr(byte_bpe, "IDS_AT_ONCE", at_once)
        flat, sizes = np.concatenate(found), np.array([len(x) for x in found])
        got = byte_bpe.load_bytes(PATH).texts(flat, sizes)
        assert got == [byte_bpe.decode(tokens, x.tolist()) for x in found] == [x.encode() for x in some]
    assert byte_bpe.load_bytes(PATH).texts(np.empty(0, np.int32), np.empty(0, np.int64)) == []
