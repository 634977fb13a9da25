"""Sentences, feeds, polygons, files, tables and datagrams."""

import socket
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidewake.functions import text as tx
from tidewake.functions.geo import centroid
from tidewake.sources import ais, assembly, datagrams, tables
from tidewake.streaming import live, sinks

#: Published sample sentences with the values of their public documentation.
SENTENCES = [
    "!AIVDM,1,1,,B,177KQJ5000G?tO`K>RA1wUbN0TKH,0*5C",
    "!AIVDM,2,2,1,A,88888888880,2*25",
    "!AIVDM,1,1,,A,B52K>;h00Fc>jpUlNV@ikwpUoP06,0*4C",
    "!AIVDM,2,1,1,A,55?MbV02;H;s<HtKR20EHE:0@T4@Dn2222222216L961O5Gf0NSQEp6ClRp8,0*1C",
    "!AIVDM,1,1,,B,C5N3SRgPEnJGEBT>NhWAwwo862PaLELTBJ:V00000000S0D:R220,0*0B",
    "!AIVDM,1,1,,A,H42O55i18tMET00000000000000,2*6D",
    "!AIVDM,1,1,,A,H42O55lt0000000D3nink000?0500,0*70",
    "!AIVDM,2,1,7,A,55?MbV02;H;s<HtKR20EHE:0@T4@Dn2222222216L961O5Gf0NSQEp6ClRp8,0*1C",
    "$GPGGA,123519,4807.038,N",
    "",
]


def _naive(payload):
    """The bits of a payload, one character after the other."""
    bits = ""
    for c in payload:
        v = ord(c) - 48
        bits += f"{v - 8 if v > 40 else v:06b}"
    return bits


@pytest.fixture(scope="module")
def decoded(spark):
    lines = spark.createDataFrame(list(enumerate(SENTENCES)), "at long, value string")
    return {(r["msg_type"], r["name"] is None): r for r in ais.decoded(assembly.assembled(lines)).collect()}


def test_position_reports(decoded):
    r = decoded[1, True]
    assert (r["mmsi"], r["status"], r["sog"], round(r["lon"], 5), round(r["lat"], 5), r["cog"], r["heading"]) == (477553000, 5, 0.0, -122.34583, 47.58283, 51.0, 181)
    r = decoded[18, True]
    assert (r["mmsi"], r["status"], r["sog"], round(r["lon"], 5), round(r["lat"], 5), r["cog"], r["heading"]) == (338087471, None, 0.1, -74.07213, 40.68454, 79.6, None)
    r = decoded[19, False]
    assert (r["mmsi"], r["sog"], round(r["lon"], 5), round(r["lat"], 5), r["cog"], r["heading"]) == (367059850, 8.7, -88.81039, 29.54369, 335.9, None)
    assert (r["name"], r["ship_type"], r["length"]) == ("CAPT.J.RIMES", 70, 26)


def test_static_reports(decoded):
    assert len(decoded) == 6
    r = decoded[5, False]
    assert (r["mmsi"], r["imo"], r["callsign"], r["name"], r["ship_type"], r["length"], r["draught"], r["destination"]) == (351759000, 9134270, "3FOF8", "EVER DIADEM", 70, 295, 12.2, "NEW YORK")
    assert (decoded[24, False]["mmsi"], decoded[24, False]["name"]) == (271041815, "PROGUY")
    r = decoded[24, True]
    assert (r["mmsi"], r["ship_type"], r["callsign"], r["length"]) == (271041815, 60, "TC6163", 15)


def test_messages_are_routed_by_type(spark):
    lines = spark.createDataFrame(list(enumerate(SENTENCES)), "at long, value string")
    positions, static = ais.routed(assembly.assembled(lines))
    assert sorted(r["msg_type"] for r in positions.collect()) == [1, 18, 19] and sorted(r["msg_type"] for r in static.collect()) == [5, 19, 24, 24]


def test_fields_against_a_bit_by_bit_reading(spark):
    payloads = [x.split(",")[5] for x in SENTENCES if x.startswith("!AIVDM,1")]
    rows = spark.createDataFrame([(p,) for p in payloads], "p string").withColumn("bits", tx.armour_bits("p"))
    fields = [(start, length) for start in (0, 1, 6, 38, 57, 61, 89, 116) for length in (1, 2, 6, 9, 27, 30)]
    got = rows.select("p", *[tx.bits_unsigned("bits", s, n).alias(f"u{s}_{n}") for s, n in fields], *[tx.bits_signed("bits", s, n).alias(f"s{s}_{n}") for s, n in fields]).collect()
    for r in got:
        bits = _naive(r["p"])
        for s, n in fields:
            value = int(bits[s : s + n], 2)
            assert r[f"u{s}_{n}"] == value and r[f"s{s}_{n}"] == (value - (1 << n) if value >> (n - 1) else value)


def test_armour_round_trip(spark):
    bits = "".join(str(i * i % 7 % 2) for i in range(168))
    r = spark.createDataFrame([(bits,)], "b string").select(tx.armoured("b", 168).alias("p")).withColumn("h", tx.armour_bits("p")).first()
    assert len(r["p"]) == 28 and _naive(r["p"]) == bits and r["h"].startswith(f"{int(bits, 2):042X}")


def test_out_of_range_values_are_null(spark):
    field = lambda value, n: f"{value % (1 << n):0{n}b}"
    bits = field(1, 6) + "00" + field(123456789, 30) + field(15, 4) + field(0, 8) + field(1023, 10) + "0" + field(181 * 600_000, 28) + field(91 * 600_000, 27) + field(3600, 12) + field(511, 9) + "0" * 31
    sent = spark.createDataFrame([(bits,)], "b string").select(tx.armoured("b", 168).alias("payload"))
    r = ais.decoded(sent).first()
    assert (r["mmsi"], r["sog"], r["lon"], r["lat"], r["cog"], r["heading"]) == (123456789, None, None, None, None, None)


def test_at_feed(spark):
    lines = ["0@1500000000@413000001@5@0.5@10.25@1@121.85@30.6@180@181", "1@x@413000001@70@9134270@CALL@200@30@p@eta@12.2@q@SHANG,HAI", "0@x@y@1@1@1@1@1@1@1@1", "2@what", ""]
    dynamic, static = ais.at_feed(spark.createDataFrame([(x,) for x in lines], "value string"))
    d, s = dynamic.collect(), static.collect()
    assert [(r["mmsi"], r["t"], r["sog"], r["lon"], r["lat"], r["cog"]) for r in d] == [(413000001, 1500000000, 10.25, 121.85, 30.6, 180.0)]
    assert [(r["mmsi"], r["ship_type"], r["imo"], r["callsign"], r["draught"], r["destination"]) for r in s] == [(413000001, 70, 9134270, "CALL", 12.2, "SHANG;HAI")]


def test_polygon_texts(spark):
    df = spark.createDataFrame([("121*30;122*31;", "30;121*31;122", "<kml><coordinates>121,30,0 122,31,0\n</coordinates><coordinates>1,2</coordinates></kml>")], "a string, b string, value string")
    r = df.select(ais.polygon_text("a", "*", ";").alias("a"), ais.polygon_text("b", ";", "*", swapped=True).alias("b")).first()
    assert [tuple(v) for v in r["a"]] == [tuple(v) for v in r["b"]] == [(121.0, 30.0), (122.0, 31.0)]
    found = ais.kml_polygons(df.select("value")).orderBy("number").collect()
    assert [[tuple(v) for v in r["vertices"]] for r in found] == [[(121.0, 30.0), (122.0, 31.0)], [(1.0, 2.0)]]


def test_files_by_day_and_exports(spark, tmp_path):
    for day in (1, 12):
        (tmp_path / f"p_{day:02d}.csv").write_text(f"{day},1.5\n{day},broken\n")
    rows = tables.read_days(spark, f"{tmp_path}/p_{{day}}.csv", [1, 12], "id long, v double").collect()
    assert sorted(map(tuple, rows)) == [(1, 1.5), (12, 1.5)]
    assert tables.read_lines(spark, f"{tmp_path}/p_01.csv").count() == 2
    tables.export_csv(spark.range(5).repartition(3), f"{tmp_path}/out")
    (only,) = (tmp_path / "out").glob("*.csv")
    assert only.read_text().split()[0] == "id" and sorted(only.read_text().split()[1:]) == ["0", "1", "2", "3", "4"]


def test_register_and_replaced_table(spark, tmp_path):
    a = spark.createDataFrame([("Sea Star", 1), ("SEA,STAR", 2)], "name string, imo int")
    b = spark.createDataFrame([("Moon", "x")], "name string, flag string")
    assert sorted(r["name"] for r in tables.cleaned_register(a, b).collect()) == ["moon", "seastar"]
    kept = {r["name"]: r for r in tables.cleaned_register(b, a, b.withColumn("name", F.lit("MOON"))).collect()}
    assert kept["seastar"]["imo"] == 1 and kept["moon"]["flag"] == "x" and tables.cleaned_register(a, order=["imo"]).first()["imo"] == 1


def test_polygon_files_with_the_number_of_their_name(spark):
    kml = "<kml><coordinates>{0},30,0 {0}.5,31,0</coordinates></kml>"
    files = spark.createDataFrame([("/x/area_1.kml", kml.format(121)), ("/x/area_12.kml", kml.format(122)), ("/x/other.kml", kml.format(1)), ("/x/area_3.kml", "")], "path string, value string")
    got = sorted((r["poly_id"] or 0, r["number"], [tuple(v) for v in r["vertices"]]) for r in ais.kml_polygon_files(files).collect())
    assert got == [(0, 0, [(1.0, 30.0), (1.5, 31.0)]), (1, 0, [(121.0, 30.0), (121.5, 31.0)]), (12, 0, [(122.0, 30.0), (122.5, 31.0)])]


def test_a_daily_job_reads_what_is_new(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = live.position_stream(spark, f"{tmp_path}/in", spark.range(1).schema)
    for n in (3, 4):
        spark.range(n).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        live.caught_up(stream, f"{tmp_path}/out", f"{tmp_path}/seen")
        assert spark.read.parquet(f"{tmp_path}/out").count() == (3 if n == 3 else 7)


def test_database_tables(spark):
    url, known = "jdbc:derby:memory:tidewake;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    put = sinks.replace_jdbc(url, "counts", known)
    put(spark.range(7).withColumn("half", F.expr("id div 2")), 0)
    put(spark.range(5).withColumn("half", F.expr("id div 2")), 1)
    assert tables.read_jdbc(spark, url, "counts", properties=known).count() == 5
    parts = tables.read_jdbc(spark, url, "counts", ['"half" < 1', '"half" >= 1'], known)
    assert parts.rdd.getNumPartitions() == 2 and parts.count() == 5
    sinks.replace_jdbc(url, "ships", known)(spark.createDataFrame([(1, "SHANG,HAI, CN")], "imo int, destination string"), 0)
    assert tables.static_register(spark, url, "ships", properties=known).first()["destination"] == "SHANG;HAI; CN"


def test_datagrams_survive_a_second_reading(tmp_path):
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as free:
        free.bind(("127.0.0.1", 0))
        port = free.getsockname()[1]
    options = {"host": "127.0.0.1", "port": str(port), "waitseconds": "1", "folder": f"file://{tmp_path}/held"}
    reader = datagrams.DatagramReader(options)

    def send():
        time.sleep(0.3)
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as out:
            for line in ("one", "two\nlines", "three"):
                out.sendto(line.encode(), ("127.0.0.1", port))

    sender = threading.Thread(target=send)
    sender.start()
    rows, end = reader.read(reader.initialOffset())
    sender.join()
    first = list(rows)
    assert first == [("one",), ("two\nlines",), ("three",)] and end == {"received": 3}
    again = datagrams.DatagramReader(options)
    assert list(again.readBetweenOffsets({"received": 0}, end)) == first and list(again.readBetweenOffsets(end, end)) == []
    assert reader.read(end)[1] == end
    assert datagrams.DatagramSource.name() == "tidewake_udp"


def test_text_helpers(spark):
    df = spark.createDataFrame([("NINGBO2", "other 7", "【warning】wind", "a&#27915;b&#49;&amp;")], "p string, q string, w string, e string")
    r = df.select(
        tx.port_name("p", ["Ningbo"]).alias("p"), tx.port_name("q", ["Ningbo"]).alias("q"), tx.without_labels("w").alias("w"), tx.entities_decoded("e").alias("e"),
        tx.commas_to_semicolons(F.lit("a,b")).alias("c"), tx.berth_name(F.lit("洋一12号")).alias("b"),
    ).first()
    assert tuple(r) == ("Ningbo", "other 7", "wind", "a洋b1&amp;", "a;b", "洋一12泊")


def test_centroid(spark):
    df = spark.createDataFrame([([(1.0, 2.0), (3.0, 6.0)],)], "v array<struct<lon:double,lat:double>>")
    assert tuple(df.select(centroid("v").alias("c")).first()["c"]) == (2.0, 4.0)
