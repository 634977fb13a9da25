"""Media columns: payloads in archives on shared storage, and a Spark data source that reads them back.

An archive is a file of members one after another, followed by a directory of their offsets, lengths,
checksums and identifiers and a fixed-size footer.  Tasks write archives under names of their own
attempt; the table ``_index`` beside them, written by Spark, names the archives of the attempts that
were committed, so a lost executor leaves an unread file at worst.

The data source ``tidewake_archive`` plans partitions as byte ranges of the archives.  A partition
takes the members that begin in its range and streams them in Arrow batches of bounded size.  A member
that cannot be read or whose checksum is wrong is tried again by its offset on a fresh handle, whatever
became of its neighbours.

The production query stores each text as an 8-bit greyscale PNG, 576 samples wide.

Edge cases: null text is empty and stored as one row of padding; a null ``doc_id`` comes back null;
repeated rows are members of their own; an empty table gives an archive directory without archives;
a very long text is one member, read whole; members are told apart by their offset, so ties do not
matter; of a table's columns ``doc_id`` and ``text`` alone are read, others may have any name.
"""

from __future__ import annotations

import hashlib
import struct
import time
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewake.llm.common import documents, shared_dir, texts

WIDTH = 576
ARCHIVE_BYTES, RANGE_BYTES, BATCH_BYTES, RETRIES = 64 << 20, 16 << 20, 8 << 20, 4
_MAGIC = b"TWARCH01"
_FOOTER = struct.Struct("<QQ8s")
_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("crc", "<u4"), ("known", "<u4"), ("id", "<i8")])
_PNG = b"\x89PNG\r\n\x1a\n"


def padded(text: bytes) -> bytes:
    """The text and bytes 255 up to a positive multiple of ``WIDTH``; 255 is in no UTF-8."""
    return text + b"\xff" * (WIDTH - len(text) % WIDTH if len(text) % WIDTH or not text else 0)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(samples: bytes, width: int = WIDTH) -> bytes:
    """A greyscale image of 8-bit samples; every row unfiltered."""
    rows = np.frombuffer(samples, np.uint8).reshape(-1, width)
    lines = np.zeros((len(rows), width + 1), np.uint8)
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 3)) + _chunk(b"IEND", b"")


def decode_png(image: bytes) -> bytes:
    """The samples of an image that ``encode_png`` made."""
    if image[:8] != _PNG:
        raise ValueError("not a PNG image")
    at, width, data = 8, 0, []
    while at < len(image):
        (size,) = struct.unpack_from(">I", image, at)
        kind, body = image[at + 4 : at + 8], image[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", image, at + 8 + size)[0]:
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            width, _, depth, colour, *_ = struct.unpack(">IIBBBBB", body)
            if (depth, colour) != (8, 0):
                raise ValueError("not 8-bit greyscale")
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, width + 1)
    if lines[:, 0].any():
        raise ValueError("filtered rows")
    return lines[:, 1:].tobytes()


def feature(samples: bytes) -> str:
    """Mean and deviation of the samples and a 64-bit average hash of as many segments."""
    values = np.frombuffer(samples, np.uint8).astype(np.float64)
    means = np.array([part.mean() for part in np.array_split(values, 64)])
    bits = np.packbits(means > values.mean()).tobytes().hex()
    return f"{values.mean():.3f}:{values.std():.3f}:{bits}"


def _opened(path: str):
    return pyarrow.fs.FileSystem.from_uri(path)


class ArchiveWriter:
    """Appends members to one archive; ``close`` writes the directory."""

    def __init__(self, path: str):
        filesystem, inner = _opened(path)
        self.path, self.out, self.entries = path, filesystem.open_output_stream(inner), []
        self.out.write(_MAGIC)
        self.at = len(_MAGIC)

    def add(self, member_id: int | None, media: bytes) -> None:
        self.entries.append((self.at, len(media), zlib.crc32(media), member_id is not None, member_id or 0))
        self.out.write(media)
        self.at += len(media)

    def close(self) -> tuple[str, int, int]:
        self.out.write(np.array(self.entries, _ENTRY).tobytes())
        self.out.write(_FOOTER.pack(self.at, len(self.entries), _MAGIC))
        self.out.close()
        return self.path.rpartition("/")[2], self.at, len(self.entries)


def write_archives(rows: DataFrame, path: str, encode) -> None:
    """Write ``doc_id, body`` of ``rows`` as members ``encode(body)`` of archives below ``path``."""

    def write(batches):
        context = TaskContext.get()
        writer, done = None, []
        for batch in batches:
            for member_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    filesystem, inner = _opened(path)
                    filesystem.create_dir(inner, recursive=True)
                    writer = ArchiveWriter(f"{path}/{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.arc")
                writer.add(member_id, encode(body.as_py()))
                if writer.at >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], ["archive", "data_end", "members"])

    rows.select("doc_id", "body").mapInArrow(write, "archive string, data_end long, members long").write.parquet(f"{path}/_index")


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    end: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.batch_bytes = int(options.get("batchbytes", BATCH_BYTES))
        self.retries = int(options.get("retries", RETRIES))

    def partitions(self) -> list[ByteRange]:
        """Byte ranges of the committed archives; the index has one row an archive."""
        filesystem, inner = _opened(f"{self.path}/_index")
        index = pyarrow.parquet.read_table(inner, filesystem=filesystem)
        out = []
        for archive, end in sorted(zip(index["archive"].to_pylist(), index["data_end"].to_pylist(), strict=True)):
            out += [ByteRange(archive, start, min(start + self.range_bytes, end)) for start in range(0, end, self.range_bytes)]
        return out or [ByteRange("", 0, 0)]

    def _member(self, archive: str, entry, handle) -> tuple[bytes, object]:
        """One member by its offset, and the handle that served it."""
        for attempt in range(self.retries + 1):
            try:
                if handle is None:
                    filesystem, inner = _opened(f"{self.path}/{archive}")
                    handle = filesystem.open_input_file(inner)
                media = handle.read_at(int(entry["length"]), int(entry["offset"]))
                if zlib.crc32(media) == entry["crc"]:
                    return media, handle
                problem = ValueError(f"wrong checksum at {entry['offset']} of {archive}")
            except OSError as error:
                problem = error
            handle = None
            time.sleep(0.05 * attempt)
        raise problem

    def _directory(self, archive: str) -> np.ndarray:
        filesystem, inner = _opened(f"{self.path}/{archive}")
        with filesystem.open_input_file(inner) as handle:
            size = handle.size()
            at, members, magic = _FOOTER.unpack(handle.read_at(_FOOTER.size, size - _FOOTER.size))
            if magic != _MAGIC:
                raise ValueError(f"{archive} is not an archive")
            return np.frombuffer(handle.read_at(members * _ENTRY.itemsize, at), _ENTRY)

    def read(self, partition: ByteRange):
        if not partition.archive:
            return
        directory = self._directory(partition.archive)
        mine = directory[(directory["offset"] >= partition.start) & (directory["offset"] < partition.end)]
        handle, rows, held = None, [], 0
        for entry in mine:
            media, handle = self._member(partition.archive, entry, handle)
            rows.append((int(entry["id"]) if entry["known"] else None, partition.archive, int(entry["offset"]), media))
            held += len(media)
            if held >= self.batch_bytes:
                yield self._batch(rows)
                rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "archive", "offset", "media"])


class ArchiveSource(DataSource):
    """``spark.read.format("tidewake_archive").load(path)``; options rangeBytes, batchBytes and retries."""

    @classmethod
    def name(cls) -> str:
        return "tidewake_archive"

    def schema(self) -> str:
        return "doc_id long, archive string, offset long, media binary"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader({k.lower(): v for k, v in self.options.items()})


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("tidewake_archive").options(**options).load(path)


def described(media: DataFrame) -> DataFrame:
    """What the stored images hold, from the bytes read back."""

    def describe(batches):
        for batch in batches:
            rows = []
            for doc_id, stored in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                image = stored.as_py()
                samples = decode_png(image)
                rows.append((doc_id, len(samples.rstrip(b"\xff")), len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(image), hashlib.sha256(image).hexdigest(), feature(samples)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    schema = ", ".join(f"{n} {'string' if k == pa.string() else 'long'}" for n, k in zip(names, kinds, strict=True))
    return media.select("doc_id", "media").mapInArrow(describe, schema)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "media")
    rows = texts(documents(spark, sf_dir)).select("doc_id", F.col("text").cast("binary").alias("body"))
    write_archives(rows, path, lambda body: encode_png(padded(body)))
    return described(read_archives(spark, path))
