"""Messages of several sentences against a line-by-line reader."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewake.sources import assembly


def read_by_line(lines, limit):
    """One dictionary of slots a key, one line after the other."""
    slots, echo, last, out = defaultdict(dict), defaultdict(dict), {}, []
    for at, line in lines:
        _, parts, part, sequence, channel, body, _ = line.split(",")
        if parts == "1":
            out.append((at, body))
            continue
        key = (parts, sequence, channel)
        if key in last and at - last[key] > limit:
            slots[key], echo[key] = {}, {}
        last[key] = at
        if echo[key].get(part) == body:
            continue
        echo[key][part] = body
        if part in slots[key]:
            slots[key] = {}
        slots[key][part] = body
        if len(slots[key]) == int(parts):
            out.append((at, "".join(b for _, b in sorted(slots[key].items()))))
            slots[key] = {}
    return sorted(out)


def feed(rng, n, gap):
    """Messages of one to three parts; parts get lost, come twice or in another order, and mix with others."""
    lines, at = [], 0.0
    for i in range(n):
        at += rng.expovariate(1 / gap)
        parts = rng.choice([1, 2, 2, 2, 3])
        order = list(range(1, parts + 1))
        if rng.random() < 0.3:
            rng.shuffle(order)
        for k, part in enumerate(order):
            for again in range(rng.choice([0, 1, 1, 1, 1, 2])):
                lines.append((round(at + 0.3 * k + 0.2 * again + rng.random() * 0.1, 6), f"!AIVDM,{parts},{part},{i % 4 if parts > 1 else ''},{rng.choice('AB') if parts == 1 else 'AB'[i % 2]},m{i}p{part},0*00"))
    times = set()
    return sorted((at, x) for at, x in lines if not (at in times or times.add(at)))


SCHEMA = "at double, value string"


@pytest.mark.parametrize("gap,limit,width", [(0.5, 3.0, 7.0), (5.0, 3.0, 11.0), (0.2, 100.0, 5.0), (2.0, 1.0, 1000.0), (1.0, 2.0, 2.0)])
def test_reads_as_line_by_line(spark, gap, limit, width):
    lines = feed(random.Random(int(10 * gap + limit)), 250, gap)
    got = assembly.assembled(spark.createDataFrame(lines, SCHEMA).repartition(4), limit=limit, width=width)
    assert sorted((r["at"], r["payload"]) for r in got.collect()) == read_by_line(lines, limit)


def test_two_messages_of_one_sequence_number(spark):
    lines = [(0, "!AIVDM,2,1,6,B,aa,0*58\r\n!AIVDM,2,2,6,B,bb,2*22\r\n"), (1, "!AIVDM,2,1,6,B,cc,0*58"), (2, "!AIVDM,2,2,6,B,dd,2*22\r\n"), (3, "noise"), (4, "!AIVDM,2,x,6,B,ee,0"), (5, "!AIVDM,2,3,6,B,ee,0"), (6, None), (7, "!AIVDO,1,1,,A,f,0*1")]
    datagrams = spark.createDataFrame(lines, "at long, value string")
    got = assembly.assembled(assembly.sentences(datagrams))
    assert sorted((r["at"], r["payload"]) for r in got.collect()) == [(0, "aabb"), (2, "ccdd"), (7, "f")]
    assert assembly.assembled(datagrams.limit(0)).collect() == []


def test_receivers_are_apart(spark):
    lines = [(0, "a", "!AIVDM,2,1,6,B,x1,0*58"), (0, "b", "!AIVDM,2,2,6,B,y2,0*58"), (1, "a", "!AIVDM,2,2,6,B,x2,0*58"), (1, None, "!AIVDM,1,1,,B,z,0*58")]
    got = assembly.assembled(spark.createDataFrame(lines, "at long, who string, value string"), receiver="who")
    assert sorted(tuple(r) for r in got.collect()) == [("", 1.0, "z"), ("a", 1.0, "x1x2")]


def test_stream_over_batches_and_a_restart(spark, tmp_path):
    lines = feed(random.Random(8), 120, 1.0)
    path, out, seen = (str(tmp_path / x) for x in ("in", "out", "seen"))
    table = spark.createDataFrame(lines, SCHEMA).withColumn("ts", F.timestamp_micros((F.col("at") * 1e6).cast("long") + 1_700_000_000_000_000))
    schema = table.schema
    for i in range(5):
        edge = [lines[len(lines) * i // 5][0], lines[len(lines) * (i + 1) // 5][0] if i < 4 else 1e9]
        table.filter((F.col("at") >= edge[0]) & (F.col("at") < edge[1])).coalesce(1).write.mode("append").parquet(path)
        stream = assembly.assembled_stream(spark.readStream.schema(schema).parquet(path), limit_s=3.0, late="1 second")
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", seen).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = spark.read.parquet(out).collect()
    assert sorted(r["payload"] for r in got) == sorted(p for _, p in read_by_line(lines, 3.0))
