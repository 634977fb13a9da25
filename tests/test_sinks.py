"""Sinks that see a batch twice, and a feed whose query is broken off and started again."""

import random
import socket
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidewake.sources import assembly, datagrams
from tidewake.streaming import sinks

from .test_assembly import SCHEMA, feed, read_by_line


def test_a_replaced_table_is_there_all_the_time(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        sinks.current_table(spark, path)
    put = sinks.replace_table(path)
    for batch, n in enumerate((9, 4, 7)):
        put(spark.range(n), batch)
        assert sinks.current_table(spark, path).count() == n
    before = sinks.current_table(spark, path)
    put(spark.range(5), 3)
    assert before.count() == 7 and sinks.current_table(spark, path).count() == 5
    put(spark.range(5), 3)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["batch-000000000002", "batch-000000000003"]


URL, KNOWN = "jdbc:derby:memory:sinks;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _database(spark, *statements):
    spark._jvm.java.lang.Class.forName(KNOWN["driver"])
    link = spark._jvm.java.sql.DriverManager.getConnection(URL)
    for s in statements:
        link.createStatement().executeUpdate(s)
    link.close()


def test_keyed_updates_happen_once(spark):
    _database(spark, 'create table berths ("ship" bigint, "n" bigint, "state" varchar(20))', "create table berths_batches (stream varchar(40), batch bigint)")
    put = sinks.upsert_jdbc(URL, "berths", ["ship"], "n", KNOWN)
    rows = lambda *r: spark.createDataFrame(r, "ship long, n long, state string")
    held = lambda: sorted(tuple(r) for r in spark.read.jdbc(URL, "berths", properties=KNOWN).collect())
    put(rows((1, 1, "open"), (2, 1, "open"), (1, 2, "full")), 0)
    assert held() == [(1, 2, "full"), (2, 1, "open")]
    put(rows((2, 5, "shut"), (3, 4, None)), 1)
    after = [(1, 2, "full"), (2, 5, "shut"), (3, 4, None)]
    assert held() == after
    # The same batch again, and an older one that was noted.
    put(rows((2, 5, "shut"), (3, 4, None)), 1)
    put(rows((1, 1, "open"), (2, 1, "open"), (1, 2, "full")), 0)
    assert held() == after
    # A merge that fails leaves neither rows nor a note, and succeeds later on.
    with pytest.raises(Exception, match="berths|BERTHS|truncat|VARCHAR"):
        put(rows((9, 1, "x" * 50)), 2)
    assert held() == after
    put(rows((9, 1, "short")), 2)
    assert held() == [*after, (9, 1, "short")]
    # Another stream has batches of its own.
    sinks.upsert_jdbc(URL, "berths", ["ship"], "n", KNOWN, stream="other")(rows((3, 9, "new")), 1)
    assert held()[2] == (3, 9, "new")


def test_every_message_once_over_a_broken_run(spark, tmp_path):
    lines = feed(random.Random(3), 90, 1.0)
    path, out, seen = (str(tmp_path / x) for x in ("in", "out", "seen"))
    table = spark.createDataFrame(lines, SCHEMA).withColumn("ts", F.timestamp_micros((F.col("at") * 2e9).cast("long") + 1_700_000_000_000_000))
    schema = table.schema
    edges = [lines[len(lines) * i // 3][0] for i in range(3)] + [1e9]
    into, broken = sinks.by_day_and_kind(out, "kind"), []

    def put(batch, batch_id):
        into(batch.withColumn("kind", F.length("payload") % 3), batch_id)
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise RuntimeError("the driver went away after the files were written")

    for i in range(3):
        table.filter((F.col("at") >= edges[i]) & (F.col("at") < edges[i + 1])).coalesce(1).write.mode("append").parquet(path)
        stream = assembly.assembled_stream(spark.readStream.schema(schema).parquet(path), limit_s=6000.0, late="1 day")
        for _ in range(2):
            q = stream.writeStream.foreachBatch(put).option("checkpointLocation", seen).trigger(availableNow=True).start()
            try:
                q.awaitTermination(120)
                break
            except Exception as why:  # noqa: BLE001
                assert "went away" in str(why)
    got = spark.read.parquet(out)
    assert broken and sorted(r["payload"] for r in got.collect()) == sorted(p for _, p in read_by_line(lines, 3.0))
    assert got.select("day").distinct().count() > 1 and got.filter(F.length("payload") % 3 != F.col("kind")).count() == 0


def _free_ports(n):
    held = [socket.socket(socket.AF_INET, socket.SOCK_DGRAM) for _ in range(n)]
    for s in held:
        s.bind(("127.0.0.1", 0))
    ports = [s.getsockname()[1] for s in held]
    for s in held:
        s.close()
    return ports


def _taken(port):
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
        try:
            s.bind(("127.0.0.1", port))
        except OSError:
            return True
    return False


def test_several_ports_to_files_by_day_and_type(spark, tmp_path):
    """Tasks listen at the same time; what they roll is read by a query, started again, into folders."""
    ports, folder = _free_ports(3), f"file://{tmp_path}/held"
    payload = "177KQJ5000G?tO`K>RA1wUbN0TKH"

    def send():
        until = time.time() + 60
        while not all(map(_taken, ports)) and time.time() < until:
            time.sleep(0.2)
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as out:
            for i in range(30):
                for port in ports:
                    part = f"!AIVDM,2,1,{i % 10},A,55?MbV02;H;s<HtKR20EHE:0@T4@Dn2222222216L961O5Gf0NSQEp6ClRp8,0*1C\r\n!AIVDM,2,2,{i % 10},A,88888888880,2*25" if i % 3 == 0 else f"!AIVDM,1,1,,B,{payload},0*5C"
                    out.sendto(part.encode(), ("127.0.0.1", port))
                time.sleep(0.02)

    sender = threading.Thread(target=send)
    sender.start()
    got = {r["receiver"]: r for r in datagrams.received(spark, [("127.0.0.1", p) for p in ports], folder, 12.0, roll_s=0.2, roll_rows=7).collect()}
    sender.join()
    assert {r: x["n"] for r, x in got.items()} == {f"127.0.0.1:{p}": 30 for p in ports} and all(x["files"] > 2 for x in got.values())
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    lines = assembly.sentences(datagrams.received_stream(spark, folder, 4).withColumnRenamed("line_no", "datagram"))
    for _ in range(2):
        stream = assembly.assembled_stream(lines, receiver="receiver", limit_s=0.05, late="1 hour")
        stream.writeStream.foreachBatch(sinks.decoded_by_day(out)).option("checkpointLocation", seen).trigger(availableNow=True).start().awaitTermination(120)
    rows = spark.read.parquet(out).groupBy("receiver", "msg_type").count().collect()
    positions = {r["receiver"]: r["count"] for r in rows if r["msg_type"] == 1}
    assert positions == {f"127.0.0.1:{p}": 20 for p in ports}
    assert {r["receiver"]: r["count"] for r in rows if r["msg_type"] == 5} == {f"127.0.0.1:{p}": 10 for p in ports}
