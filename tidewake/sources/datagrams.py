"""UDP datagrams as a stream.

``received`` listens on many ports at once: one task of a Spark job holds the socket of one port and rolls what arrives into files
of a shared folder, which appear whole or not at all; ``received_stream`` reads that folder.  The job is run by an outside
scheduler for as long as the feed lasts, next to the query that reads.

For a single port ``tidewake_udp`` needs no job beside the query: its socket is read where the query is driven, and what arrives is
written to a folder before a batch is planned, so a batch that is run again after a failure reads the same datagrams.
"""

from __future__ import annotations

import json
import socket
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class DatagramReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.address = (options.get("host", "0.0.0.0"), int(options["port"]))
        self.wait = float(options.get("waitseconds", 0.2))
        self.folder = options["folder"]
        self.socket = None

    def _file(self, start: int, end: int):
        filesystem, path = pyarrow.fs.FileSystem.from_uri(self.folder)
        filesystem.create_dir(path, recursive=True)
        return filesystem, f"{path}/received-{start:020d}-{end:020d}.json"

    def initialOffset(self) -> dict:  # noqa: N802
        return {"received": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if self.socket is None:
            self.socket = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
            self.socket.bind(self.address)
            self.socket.settimeout(self.wait)
        rows, until = [], time.monotonic() + self.wait
        while time.monotonic() < until:
            try:
                rows.append((self.socket.recv(65_535).decode("utf-8", "replace"),))
            except TimeoutError:
                break
        first, last = start["received"], start["received"] + len(rows)
        if rows:
            filesystem, path = self._file(first, last)
            with filesystem.open_output_stream(path) as out:
                out.write("\n".join(json.dumps(value) for (value,) in rows).encode())
        return iter(rows), {"received": last}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """The datagrams of a batch that runs again, from the folder."""
        filesystem, path = self._file(start["received"], end["received"])
        known = filesystem.get_file_info(pyarrow.fs.FileSelector(path.rpartition("/")[0]))
        rows = []
        for info in sorted(known, key=lambda x: x.base_name):
            first, last = (int(x) for x in info.base_name.removesuffix(".json").split("-")[1:])
            if start["received"] <= first and last <= end["received"]:
                with filesystem.open_input_file(info.path) as held:
                    rows += [(json.loads(line),) for line in held.readall().decode().split("\n")]
        return iter(rows)


class DatagramSource(DataSource):
    """``readStream.format("tidewake_udp").options(port=…, folder=…)``; one column ``value``."""

    @classmethod
    def name(cls) -> str:
        return "tidewake_udp"

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema) -> DatagramReader:  # noqa: N802
        return DatagramReader({k.lower(): v for k, v in self.options.items()})


RECEIVED = "at double, line_no long, receiver string, value string"


def _rolled(folder: str, rows: list[dict]) -> None:
    """The rows as a new file of the folder: written under a name that readers pass over, then renamed."""
    filesystem, path = pyarrow.fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    with filesystem.open_output_stream(f"{path}/_{name}") as out:
        out.write("\n".join(map(json.dumps, rows)).encode())
    filesystem.move(f"{path}/_{name}", f"{path}/received-{name}.json")


def received(spark: SparkSession, addresses: list[tuple[str, int]], folder: str, seconds: float, roll_s: float = 5.0, roll_rows: int = 10_000) -> DataFrame:
    """``receiver, n, files``: how many datagrams each address got in ``seconds``; one task an address, all at the same time.

    Needs as many free task slots as there are addresses.  A task that is lost loses what it has not rolled, ``roll_s`` seconds or
    ``roll_rows`` datagrams, as a datagram has no second copy; files that it has rolled stay, and its retry adds to them.
    """

    def listen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                host, port = addresses[i]
                held, n, files, rolled = [], 0, 0, time.time()
                with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as link:
                    link.setsockopt(socket.SOL_SOCKET, socket.SO_RCVBUF, 1 << 22)
                    link.bind((host, port))
                    until = time.time() + seconds
                    while (now := time.time()) < until:
                        link.settimeout(max(0.01, min(until - now, rolled + roll_s - now)))
                        try:
                            value = link.recv(65_535).decode("utf-8", "replace")
                            held.append({"at": time.time(), "line_no": n, "receiver": f"{host}:{port}", "value": value})
                            n += 1
                        except TimeoutError:
                            pass
                        if held and (len(held) >= roll_rows or time.time() >= rolled + roll_s):
                            _rolled(folder, held)
                            held, files = [], files + 1
                        if time.time() >= rolled + roll_s:
                            rolled = time.time()
                if held:
                    _rolled(folder, held)
                    files += 1
                yield pa.RecordBatch.from_arrays([pa.array([f"{host}:{port}"]), pa.array([n], pa.int64()), pa.array([files], pa.int64())], ["receiver", "n", "files"])

    return spark.range(0, len(addresses), 1, len(addresses)).mapInArrow(listen, "receiver string, n long, files long")


def received_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """The folder that ``received`` fills, as a stream with the time of arrival as ``ts``."""
    rows = spark.readStream.schema(RECEIVED).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "received-*.json").json(folder)
    return rows.withColumn("ts", F.timestamp_micros((F.col("at") * 1e6).cast("long")))
