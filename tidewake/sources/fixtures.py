"""Vessel-shaped tables derived from the star-schema tables: points, polygons, ports and voyages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITES_X, SITES_Y = 7, 5
SITE_SECONDS = 259_200
PORTS = 35


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of ships that stay at one of 35 sites for three days each, with a jitter of metres."""
    e = table(spark, sf_dir, "events")
    raw = e.select(
        F.col("user_id").alias("mmsi"),
        "event_id",
        F.expr("unix_micros(cast(ts as timestamp)) div 1000000").alias("t"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.col("value").alias("sog"),
        "event_type",
    )
    d = F.expr(f"t div {SITE_SECONDS}")
    return raw.select(
        "*",
        (F.lit(121.0) + F.lit(0.5) * ((F.col("mmsi") + d) % SITES_X) + F.col("k") * F.lit(1e-6)).alias("lon"),
        (F.lit(30.0) + F.lit(0.25) * ((F.col("mmsi") * 3 + d) % SITES_Y) + F.col("k") * F.lit(1e-6)).alias("lat"),
        ((F.col("mmsi") + d) % SITES_X + SITES_X * ((F.col("mmsi") * 3 + d) % SITES_Y)).alias("site"),
        (F.col("k") * 37 % 360).alias("cog"),
        (F.col("k") * 53 % 360).alias("head"),
        (F.col("k") % 16).alias("status"),
        F.expr("80 + (mmsi + t div 864000) % 4 * 5").alias("draught"),
    )


def _sites(spark: SparkSession) -> DataFrame:
    return spark.range(SITES_X * SITES_Y).select(
        F.col("id").alias("site"), (F.lit(121.0) + F.lit(0.5) * (F.col("id") % SITES_X)).alias("x"), (F.lit(30.0) + F.lit(0.25) * F.expr(f"id div {SITES_X}")).alias("y")
    )


def polygons(spark: SparkSession) -> DataFrame:
    """A square around part of every even site: ``polygon, vertices`` and the bounding box."""
    low, high = F.lit(-1e-5), F.lit(5.05e-5)
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("lon"), (F.col("y") + dy).alias("lat"))
    return _sites(spark).filter("site % 2 = 0").select(
        F.format_string("P%02d", "site").alias("polygon"),
        F.array(corner(low, low), corner(high, low), corner(high, high), corner(low, high)).alias("vertices"),
        (F.col("x") + low).alias("west"), (F.col("x") + high).alias("east"), (F.col("y") + low).alias("south"), (F.col("y") + high).alias("north"),
    )


def site_gate(site: str) -> Column:
    """The gate at a site, if any: A, B or C."""
    return F.when(F.col(site) == 0, "A").when(F.col(site) == 8, "B").when(F.col(site) == 27, "C")


def ports(spark: SparkSession) -> DataFrame:
    """``port, port_lon, port_lat, level``: 0 a port, 1 a terminal, 2 a berth."""
    return spark.range(PORTS).select(
        F.col("id").alias("port"),
        (F.lit(121.0) + F.lit(0.5) * (F.col("id") % 7) + F.lit(0.05) * (F.col("id") % 8)).alias("port_lon"),
        (F.lit(30.0) + F.lit(0.25) * F.expr("id div 7") + F.lit(0.01) * (F.col("id") % 5)).alias("port_lat"),
        (F.col("id") % 3).cast("int").alias("level"),
    )


def voyages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voyage rows: ship, time, ports of departure and arrival, capacity and distance."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("voyage"),
        F.col("o_custkey").alias("ship"),
        F.expr("unix_micros(cast(o_orderdate as timestamp)) div 1000000").alias("t"),
        (F.col("o_custkey") % 25).alias("start_port"),
        (F.col("o_orderkey") % 25).alias("end_port"),
        (F.lit(1000) + F.col("o_custkey") % 4 * 1000).alias("teu"),
        (F.col("o_totalprice") / 100).alias("distance"),
    )


#: The same tables for DuckDB, as common table expressions.
POINTS_SQL = """
raw_points AS (
  SELECT user_id AS mmsi, event_id, epoch_us(ts) // 1000000 AS t, CAST(props->>'$.k' AS BIGINT) AS k, value AS sog, event_type FROM events
), points AS (
  SELECT *, 121.0e0 + 0.5e0 * ((mmsi + t // 259200) % 7) + k * 1e-6::DOUBLE AS lon,
         30.0e0 + 0.25e0 * ((mmsi * 3 + t // 259200) % 5) + k * 1e-6::DOUBLE AS lat,
         (mmsi + t // 259200) % 7 + 7 * ((mmsi * 3 + t // 259200) % 5) AS site,
         k * 37 % 360 AS cog, k * 53 % 360 AS head, k % 16 AS status, 80 + (mmsi + t // 864000) % 4 * 5 AS draught
  FROM raw_points
)"""
POLYGONS_SQL = """
sites AS (SELECT range AS site, 121.0e0 + 0.5e0 * (range % 7) AS x, 30.0e0 + 0.25e0 * (range // 7) AS y FROM range(35)),
polygons AS (
  SELECT printf('P%02d', site) AS polygon, x - 1e-5::DOUBLE AS west, x + 5.05e-5::DOUBLE AS east, y - 1e-5::DOUBLE AS south, y + 5.05e-5::DOUBLE AS north FROM sites WHERE site % 2 = 0
)"""
PORTS_SQL = """
ports AS (
  SELECT range AS port, 121.0e0 + 0.5e0 * (range % 7) + 0.05e0 * (range % 8) AS port_lon,
         30.0e0 + 0.25e0 * (range // 7) + 0.01e0 * (range % 5) AS port_lat, CAST(range % 3 AS INTEGER) AS level FROM range(35)
)"""
VOYAGES_SQL = """
voyages AS (
  SELECT o_orderkey AS voyage, o_custkey AS ship, epoch_us(o_orderdate) // 1000000 AS t, o_custkey % 25 AS start_port,
         o_orderkey % 25 AS end_port, 1000 + o_custkey % 4 * 1000 AS teu, o_totalprice / 100 AS distance FROM orders
)"""


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = f"power(sin((radians({lat1}) - radians({lat2})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon1}) - radians({lon2})) / 2), 2)"
    return f"(round_even(2 * asin(sqrt({a})) * 6378.137e0 * 1e8, 0) / 1e8)"


def cell_sql(lon: str, lat: str) -> str:
    x = f"CASE WHEN {lon} < 0 THEN 1799.5e0 - floor(abs({lon} / 0.1e0)) ELSE 1799.5e0 + ceil({lon} / 0.1e0) END"
    y = f"CASE WHEN {lat} < 0 THEN 899.5e0 + ceil(abs({lat} / 0.1e0)) ELSE 899.5e0 - floor({lat} / 0.1e0) END"
    return f"CAST(trunc(({x}) + ({y}) * 3600e0) AS BIGINT)"
