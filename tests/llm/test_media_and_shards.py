import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewake.llm import feistel, media, packing, queries, token_shards
from tidewake.llm.common import texts

from .conftest import SF


def want(text):
    p = text + b"\xff" * ((-len(text)) % 576 or (0 if text else 576))
    return len(text), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])


def test_query(spark, table):
    seen = {}
    for r in queries.QUERIES["op4_media_columns"](spark, SF).collect():
        text = table[r["doc_id"]].encode()
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == want(text)
        assert seen.setdefault(text, (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])


def test_odd_rows_ranges_and_batches(spark, odd, odd_rows, nothing, tmp_path):
    for name, rows, expected in (("odd", odd, odd_rows), ("none", nothing, [])):
        path = f"file://{tmp_path}/{name}"
        media.write_archives(texts(rows).select("doc_id", F.col("text").cast("binary").alias("body")), path, lambda b: media.encode_png(media.padded(b)))
        back = media.read_archives(spark, path, rangeBytes=700, batchBytes=100)
        got = sorted(((r["doc_id"], media.decode_png(bytes(r["media"])).rstrip(b"\xff").decode()) for r in back.collect()), key=repr)
        assert got == sorted(((r[0], r[1] or "") for r in expected), key=repr)


def test_members_are_retried_by_offset(tmp_path, monkeypatch):
    path = f"file://{tmp_path}"
    writer = media.ArchiveWriter(f"{path}/a.arc")
    bodies = [bytes([i]) * (100 + i) for i in range(20)]
    for i, b in enumerate(bodies):
        writer.add(i, b)
    _, end, _ = writer.close()
    opened, real = [], media._opened

    class Handle:
        def __init__(self, handle, bad):
            self.handle, self.bad = handle, bad

        def __getattr__(self, name):
            return getattr(self.handle, name)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read_at(self, n, at):
            if self.bad and 500 < at < 900:
                raise OSError("lost connection")
            return self.handle.read_at(n, at)

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, p):
            opened.append(p)
            return Handle(self.fs.open_input_file(p), len(opened) == 2)

    monkeypatch.setattr(media, "_opened", lambda p: (Files(real(p)[0]), real(p)[1]))
    reader = media.ArchiveReader({"path": path, "batchbytes": "300"})
    out = [m for batch in reader.read(media.ByteRange("a.arc", 0, end)) for m in batch.column(3).to_pylist()]
    assert out == bodies and len(opened) == 3
    damaged = bytearray((tmp_path / "a.arc").read_bytes())
    damaged[200] ^= 1
    (tmp_path / "a.arc").write_bytes(damaged)
    monkeypatch.setattr(media.time, "sleep", lambda _: None)
    with pytest.raises(ValueError, match="wrong checksum"):
        list(reader.read(media.ByteRange("a.arc", 0, end)))


def test_png_is_lossless_and_checked():
    samples = os.urandom(576 * 7)
    image = media.encode_png(samples)
    assert media.decode_png(image) == samples
    with pytest.raises(ValueError):
        media.decode_png(image[:60] + b"x" + image[61:])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 1025])
def test_feistel_is_a_permutation(n):
    assert sorted(feistel.permute_array(np.arange(n), n, 7).tolist()) == list(range(n))
    assert sorted(feistel.permute(i, n, b"k") for i in range(n)) == list(range(n))
    if n > 5:
        assert feistel.permute_array(np.arange(n), n, 7).tolist() != feistel.permute_array(np.arange(n), n, 8).tolist()


def test_shards_hold_every_token_in_training_order(spark, odd, odd_rows, nothing, tmp_path):
    vocabulary, path = public_tokenizers.path(packing.VOCABULARY), f"file://{tmp_path}/shards"
    index = token_shards.write_shards(odd, path, vocabulary, length=64, shards=5)
    rows = index.orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    ids = token_shards.read_slots(index, path, 0, len(rows), length=64)
    assert [zlib.crc32(x.tobytes()) for x in ids] == [r["ids_crc32"] for r in rows]
    words = packing.load(vocabulary)
    total = sum(len(words.encode((r[1] or "").encode())) // 4 + 1 for r in odd_rows)
    assert 0 <= len(rows) * 64 - total < 3 * 64
    assert np.concatenate(token_shards.read_slots(index, path, 3, 4, length=64)).tolist() == np.concatenate(ids[3:7]).tolist()
    assert {d for r in rows for d in r["doc_ids"]} == {r[0] for r in odd_rows}
    assert token_shards.write_shards(nothing, f"{path}-none", vocabulary).collect() == []


def test_every_slot_against_brute_force(spark, table, tmp_path):
    """One task in the order of ``doc_id``: the ids of all texts in a row, cut, and put in the order of their permuted numbers."""
    vocabulary, path, length = public_tokenizers.path(packing.VOCABULARY), f"file://{tmp_path}/shards", 256
    docs = spark.createDataFrame(sorted(table.items()), "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(vocabulary)
    ids = [i for _, text in sorted(table.items()) for i in (*library.encode(text, add_special_tokens=False).ids, token_shards.END_ID)]
    ids += [token_shards.END_ID] * (-len(ids) % length)
    cut = [ids[i : i + length] for i in range(0, len(ids), length)]
    places = feistel.permute_array(np.arange(len(cut)), token_shards.PER_TASK, token_shards.KEY)
    index = token_shards.write_shards(docs, path, vocabulary, length=length, shards=7)
    assert [x.tolist() for x in token_shards.read_slots(index, path, 0, len(cut), length)] == [cut[i] for i in np.argsort(places)]
    assert index.count() == len(cut) and index.select("shard").distinct().count() == 7


def test_shard_query(spark, table):
    out = queries.QUERIES["op7_token_shards"](spark, SF)
    assert {d for r in out.collect() for d in r["doc_ids"]} == set(table)
