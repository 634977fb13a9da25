"""Channels as polylines with running times: where a ship is along one, and when it enters and leaves the guarded water ahead.

A channel model holds, vertex by vertex, ``channel_id, seq, lon, lat, run_s, inside``: ``run_s`` is the time that
ships take to get there from the channel's start, ``inside`` whether the vertex lies in the guarded water.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.functions.geo import KM_PER_DEGREE, compass_bearing, haversine_km
from tidewake.operators.rules import sector_forecast
from tidewake.operators.spatial import small

REACH_KM, GRADE = 1.5, 0.05
SLOT_S = 600


def pieces(model: DataFrame) -> DataFrame:
    """The straight pieces between neighbouring vertices: ends, running times, course, and the scale of longitude at the first end."""
    w = Window.partitionBy("channel_id").orderBy("seq")
    ahead = {f"{name}_2": F.lead(name).over(w) for name in ("lon", "lat", "run_s")}
    rows = model.withColumns(ahead).filter("lon_2 is not null")
    return rows.select("channel_id", "seq", "lon", "lat", "run_s", *ahead, F.cos(F.radians("lat")).alias("scale"), compass_bearing("lon", "lat", "lon_2", "lat_2").alias("course"))


def gates(model: DataFrame) -> DataFrame:
    """When a channel enters the guarded water first and leaves it last, in running time; channels that never do are left out."""
    inner = F.when(F.col("inside"), F.col("run_s"))
    return model.groupBy("channel_id").agg(F.min(inner).alias("gate_in_s"), F.max(inner).alias("gate_out_s")).filter("gate_in_s is not null")


def _cells(rows: DataFrame, reach_km: float) -> DataFrame:
    """Each piece under the cells that it passes within ``reach_km``: it is cut into stretches of a cell's size, and each has its box."""
    steps = F.greatest(F.ceil(F.greatest(F.abs(F.col("lon_2") - F.col("lon")), F.abs(F.col("lat_2") - F.col("lat"))) / GRADE), F.lit(1)).cast("int")
    stretch = rows.withColumn("part", F.explode(F.sequence(F.lit(0), steps - 1))).withColumn("parts", steps)
    at = lambda name, i: F.col(name) + (F.col(f"{name}_2") - F.col(name)) * i / F.col("parts")
    reach_y = reach_km / KM_PER_DEGREE
    reach_x = F.lit(reach_y) / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("lat")), F.abs(F.col("lat_2"))) + F.abs(F.col("lat_2") - F.col("lat")) + reach_y)), F.lit(0.01))

    def span(name: str, reach: Column) -> Column:
        a, b = at(name, F.col("part")), at(name, F.col("part") + 1)
        return F.sequence(F.floor((F.least(a, b) - reach) / GRADE), F.floor((F.greatest(a, b) + reach) / GRADE))

    out = stretch.withColumn("x", F.explode(span("lon", reach_x))).withColumn("y", F.explode(span("lat", F.lit(reach_y))))
    return out.drop("part", "parts").distinct()


def along_channels(latest: DataFrame, model: DataFrame, reach_km: float = REACH_KM) -> DataFrame:
    """``mmsi, channel_id, channel_km, now_s`` of ships within reach of a channel whose course is less than 90 degrees from theirs.

    A position is projected on every piece near it; the nearest piece decides, and the running time is that of the
    projected place.  Ships and pieces meet by grid cells.  ``latest`` has ``mmsi, lon, lat, cog``.
    """
    line = _cells(pieces(model), reach_km).withColumnsRenamed({"lon": "lon_1", "lat": "lat_1"})
    ships = latest.select("mmsi", "lon", "lat", "cog", F.floor(F.col("lon") / GRADE).alias("x"), F.floor(F.col("lat") / GRADE).alias("y"))
    dx, dy = (F.col("lon_2") - F.col("lon_1")) * F.col("scale"), F.col("lat_2") - F.col("lat_1")
    px, py = (F.col("lon") - F.col("lon_1")) * F.col("scale"), F.col("lat") - F.col("lat_1")
    length = dx * dx + dy * dy
    f = F.when(length > 0, F.least(F.greatest((px * dx + py * dy) / length, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    gap = F.abs(F.col("cog") - F.col("course"))
    met = ships.join(small(line), ["x", "y"]).filter(F.least(gap, 360 - gap) < 90).withColumn("f", f)
    foot = lambda name: F.col(f"{name}_1") + (F.col(f"{name}_2") - F.col(f"{name}_1")) * F.col("f")
    met = met.withColumn("km", haversine_km("lon", "lat", foot("lon"), foot("lat"))).filter(F.col("km") < reach_km)
    now = F.col("run_s") + (F.col("run_s_2") - F.col("run_s")) * F.col("f")
    best = met.groupBy("mmsi").agg(F.min(F.struct("km", "channel_id", "seq", now.alias("now_s"))).alias("b"))
    return best.select("mmsi", F.col("b.channel_id").alias("channel_id"), F.col("b.km").alias("channel_km"), F.round("b.now_s", 3).alias("now_s"))


def forecast(latest: DataFrame, model: DataFrame, lon: float, lat: float, radius_km: float, speed_kmh: Column, reach_km: float = REACH_KM) -> DataFrame:
    """``mmsi, channel_id, enter_s, leave_s``: by the times of the ship's own channel where both are still ahead, else by course and speed towards the circle, without a channel."""
    placed = along_channels(latest, model, reach_km).join(small(gates(model)), "channel_id")
    ahead = placed.select("mmsi", "channel_id", (F.col("gate_in_s") - F.col("now_s")).alias("enter_s"), (F.col("gate_out_s") - F.col("now_s")).alias("leave_s")).filter("enter_s > 0 and leave_s > 0")
    free = sector_forecast(latest.join(ahead, "mmsi", "left_anti"), lon, lat, radius_km, speed_kmh)
    return ahead.unionByName(free.select("mmsi", F.lit(None).cast("long").alias("channel_id"), F.col("enter_s").cast("double").alias("enter_s"), F.col("leave_s").cast("double").alias("leave_s")))
