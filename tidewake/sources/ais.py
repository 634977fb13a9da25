"""AIS sentences and supplier feeds to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import c, cell_id
from tidewake.functions.text import armour_bits, bits_signed, bits_text, bits_unsigned, parsed_once

SUPPLIER_TABBED, SUPPLIER_COMMA = 246, 248
KNOT_M_S = 0.514444


def _position(bits: Column, lon: int, lat: int) -> tuple[Column, Column]:
    x, y = bits_signed(bits, lon, 28) / 600_000.0, bits_signed(bits, lat, 27) / 600_000.0
    return F.when(F.abs(x) <= 180, x), F.when(F.abs(y) <= 90, y)


def decoded(messages: DataFrame, payload: str = "payload", carried: list[str] | None = None) -> DataFrame:
    """Position reports (1, 2, 3, 18, 19) and static reports (5, 24A, 24B) with one column a field; null where a type has none or the value is out of range; columns ``carried`` come along."""
    rows = messages.withColumn("bits", armour_bits(payload))
    bits = F.col("bits")
    kind = bits_unsigned(bits, 0, 6)
    a, b = kind.isin(1, 2, 3), kind.isin(18, 19)
    lon_a, lat_a = _position(bits, 61, 89)
    lon_b, lat_b = _position(bits, 57, 85)
    part = bits_unsigned(bits, 38, 2)
    speed = F.when(a, bits_unsigned(bits, 50, 10)).when(b, bits_unsigned(bits, 46, 10))
    course = F.when(a, bits_unsigned(bits, 116, 12)).when(b, bits_unsigned(bits, 112, 12))
    heading = F.when(a, bits_unsigned(bits, 128, 9)).when(b, bits_unsigned(bits, 124, 9))
    length = F.when(kind == 5, bits_unsigned(bits, 240, 9) + bits_unsigned(bits, 249, 9)).when((kind == 24) & (part == 1), bits_unsigned(bits, 132, 9) + bits_unsigned(bits, 141, 9)).when(kind == 19, bits_unsigned(bits, 271, 9) + bits_unsigned(bits, 280, 9))
    return rows.select(
        *(carried or []),
        kind.cast("int").alias("msg_type"),
        bits_unsigned(bits, 8, 30).alias("mmsi"),
        F.when(a, bits_unsigned(bits, 38, 4)).cast("int").alias("status"),
        F.when(speed <= 1022, speed / 10).alias("sog"),
        F.when(a, lon_a).when(b, lon_b).alias("lon"),
        F.when(a, lat_a).when(b, lat_b).alias("lat"),
        F.when(course <= 3599, course / 10).alias("cog"),
        F.when(heading <= 359, heading).cast("int").alias("heading"),
        F.when(kind == 5, bits_unsigned(bits, 40, 30)).alias("imo"),
        F.when(kind == 5, bits_text(bits, 70, 7)).when((kind == 24) & (part == 1), bits_text(bits, 90, 7)).alias("callsign"),
        F.when(kind == 5, bits_text(bits, 112, 20)).when((kind == 24) & (part == 0), bits_text(bits, 40, 20)).when(kind == 19, bits_text(bits, 143, 20)).alias("name"),
        F.when(kind == 5, bits_unsigned(bits, 232, 8)).when((kind == 24) & (part == 1), bits_unsigned(bits, 40, 8)).when(kind == 19, bits_unsigned(bits, 263, 8)).cast("int").alias("ship_type"),
        length.cast("int").alias("length"),
        F.when(kind == 5, bits_unsigned(bits, 294, 8) / 10).alias("draught"),
        F.when(kind == 5, bits_text(bits, 302, 20)).alias("destination"),
    )


def routed(messages: DataFrame, payload: str = "payload", carried: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Position reports and static reports, each with its own columns."""
    rows, own = decoded(messages, payload, carried), [*(carried or []), "msg_type", "mmsi"]
    positions = rows.filter(F.col("msg_type").isin(1, 2, 3, 18, 19)).select(*own, "status", "sog", "lon", "lat", "cog", "heading")
    static = rows.filter(F.col("msg_type").isin(5, 19, 24)).select(*own, "imo", "callsign", "name", "ship_type", "length", "draught", "destination")
    return positions, static


def _thr(mmsi, t, supplier, source, status, lon, lat, speed, cog, head, rot, accuracy) -> list[Column]:
    """The position table's columns; degrees inside, micro-degrees only where files hold them."""
    return [
        mmsi.try_cast("long").alias("mmsi"), t.try_cast("long").alias("t"), F.lit(supplier).alias("supplier"), F.lit(source).alias("source"), status.try_cast("int").alias("status"),
        lon.alias("lon"), lat.alias("lat"), cell_id(lon, lat).alias("cell"), speed.alias("speed"), F.lit(KNOT_M_S).alias("conversion"),
        cog.try_cast("double").cast("int").alias("cog"), head.try_cast("double").cast("int").alias("head"), F.struct(rot.try_cast("double").alias("rot"), accuracy.try_cast("int").alias("pos_acc")).alias("extend"),
    ]


def tabbed_supplier(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated rows: the second column ``mmsi time``, the fourth ``status@rot@speed@accuracy@lon@lat@cog@head…@type``; header and broken rows are dropped."""
    split = parsed_once(lines.filter(~F.contains(F.col(line), F.lit("value"))).select(line), f=F.split(line, "\t")).filter(F.size("f") >= 4)
    rows = parsed_once(split, who=F.split(F.get("f", F.lit(1)), " "), d=F.split(F.get("f", F.lit(3)), "@")).filter((F.size("d") >= 8) & (F.size("who") >= 2))
    who, d = F.col("who"), F.col("d")
    lon, lat = d[4].try_cast("double"), d[5].try_cast("double")
    out = rows.select(*_thr(who[0], who[1], SUPPLIER_TABBED, 0, d[0], lon, lat, d[2].try_cast("double"), d[6], d[7], d[1], d[3]), F.element_at(d, -1).try_cast("int").alias("ship_type"))
    return out.dropna(subset=["mmsi", "t", "lon", "lat"])


def comma_supplier(lines: DataFrame, line: str = "value", rescale: bool = True) -> DataFrame:
    """Comma-separated rows of 15 fields, the fourth of them dropped, the speed in thousandths of a knot rescaled."""
    rows = parsed_once(lines.filter(~F.contains(F.col(line), F.lit("longitude"))).select(line), f=F.split(line, ",")).filter(F.size("f") >= 15)
    f = F.col("f")
    lon, lat = f[6].try_cast("double") / 1e6, f[7].try_cast("double") / 1e6
    speed = f[9].try_cast("double") * (0.001 * KNOT_M_S * 10 if rescale else 1.0)
    out = rows.select(*_thr(f[0], f[1], SUPPLIER_COMMA, 0, f[5], lon, lat, speed, f[11], f[12], F.split(f[14], "&")[0], F.split(f[14], "&")[1]))
    return out.dropna(subset=["mmsi", "t", "lon", "lat"])


def cargo_rows(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated rows of ship types 70 to 79."""
    return tabbed_supplier(lines, line).filter("ship_type between 70 and 79")


def rows_between(lines: DataFrame, west: float = 70.0, east: float = 89.0, line: str = "value") -> DataFrame:
    """Tab-separated rows of a window of longitudes."""
    return tabbed_supplier(lines, line).filter(F.col("lon").between(west, east))


def boxed_positions(lines: DataFrame, west: float, east: float, south: float, north: float, ship_type: int | None = None, line: str = "value") -> DataFrame:
    """``mmsi, t, lon, lat`` of the tab-separated rows in a box, of one ship type where it is given."""
    rows = tabbed_supplier(lines, line).filter(F.col("lon").between(west, east) & F.col("lat").between(south, north))
    return (rows if ship_type is None else rows.filter(F.col("ship_type") == ship_type)).select("mmsi", "t", "lon", "lat")


def position_text(lines: DataFrame, line: str = "value") -> DataFrame:
    """Comma-separated positions ``id,time,lon,lat,status,zone,sog,cog,head,rot``; rows that do not fit are dropped."""
    kinds = {"mmsi": "long", "t": "long", "lon": "double", "lat": "double", "status": "int", "zone": "int", "sog": "double", "cog": "double", "head": "double", "rot": "double"}
    f = F.col("f")
    rows = parsed_once(lines.select(line), f=F.split(line, ",")).filter(F.size(f) >= len(kinds))
    return rows.select(*[f[i].try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds.items())]).dropna()


def at_feed(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Dynamic and static rows of a feed of ``@``-separated fields, told apart by the first."""
    f = F.col("f")
    number = lambda i, kind: f[i].try_cast(kind)
    rows = parsed_once(lines.select(line), f=F.split(line, "@"))
    dynamic = rows.filter((f[0] == "0") & (F.size(f) >= 11)).select(
        number(2, "long").alias("mmsi"), number(1, "long").alias("t"), number(3, "int").alias("status"), number(4, "double").alias("rot"), number(5, "double").alias("sog"), number(6, "int").alias("pos_acc"),
        number(7, "double").alias("lon"), number(8, "double").alias("lat"), cell_id(number(7, "double"), number(8, "double")).alias("cell"), number(9, "double").alias("cog"), number(10, "double").alias("head"),
    )
    static = rows.filter((f[0] == "1") & (F.size(f) >= 13)).select(
        number(2, "long").alias("mmsi"), number(3, "int").alias("ship_type"), number(4, "long").alias("imo"), f[5].alias("callsign"), number(6, "double").alias("length"), number(7, "double").alias("width"),
        f[9].alias("eta"), number(10, "double").alias("draught"), F.translate(f[12], ",", ";").alias("destination"),
    )
    return dynamic.dropna(subset=["mmsi", "t"]), static.dropna(subset=["mmsi"])


def polygon_text(text, pair: str, vertex: str, swapped: bool = False) -> Column:
    """Vertices of ``lon*lat;lon*lat;`` or, swapped, ``lat;lon*lat;lon``: ``pair`` parts a vertex, ``vertex`` parts the list."""
    ends = (1, 0) if swapped else (0, 1)
    parts = F.filter(F.split(c(text), f"[{vertex}]"), lambda x: x != "")
    number = lambda x, i: F.split(x, f"[{pair}]")[ends[i]].cast("double")
    return F.transform(parts, lambda x: F.struct(number(x, 0).alias("lon"), number(x, 1).alias("lat")))


def kml_polygons(files: DataFrame, content: str = "value") -> DataFrame:
    """Vertices of every ``<coordinates>`` of KML texts, numbered."""
    found = F.regexp_extract_all(F.col(content), F.lit(r"(?s)<coordinates>(.*?)</coordinates>"), F.lit(1))
    vertex = lambda x: F.struct(F.split(x, ",")[0].cast("double").alias("lon"), F.split(x, ",")[1].cast("double").alias("lat"))
    rows = files.withColumn("found", F.transform(found, lambda x: F.transform(F.filter(F.split(F.trim(x), r"\s+"), lambda y: y != ""), vertex))).drop(content)
    return rows.select("*", F.posexplode("found").alias("number", "vertices")).drop("found")


def kml_polygon_files(files: DataFrame, content: str = "value", path: str = "path") -> DataFrame:
    """``poly_id, number, vertices`` of KML files of one polygon set each, whose number stands at the end of the file's name."""
    named = files.select(F.col(content).alias("value"), F.regexp_extract(path, r"([0-9]+)\.[^./]*$", 1).try_cast("long").alias("poly_id"))
    return kml_polygons(named).select("poly_id", "number", "vertices")
