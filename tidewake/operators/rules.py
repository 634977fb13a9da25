"""Rule tables and live decisions: range lookups, berth and bridge admission, forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import acute_difference, approaching, compass_bearing, haversine_km, sector_times
from tidewake.functions.text import reasons
from tidewake.operators.spatial import nearest_by_rings, points_in_polygons, small

BANDS = 64


def _band(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` are no more than ``value``, by halving."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), below(low, middle)).otherwise(below(middle + 1, high))

    return below(0, len(cuts))


def range_lookup(rows: DataFrame, keys: list[str], value: str, rules: DataFrame, result: str) -> DataFrame:
    """``keys`` and the ``result`` of the last rule with ``low <= value <= high``; null without one.  ``rules`` has ``seq, low, high`` and the result.

    The line is cut at the rules' own bounds, at up to ``BANDS`` of their quantiles where there are more; a rule stands in
    each band that it touches, a row in one, and they meet by an equi-join.  So bands are as fine as the rules are close, and an
    open-ended rule does no harm.
    """
    bounds = rules.select(F.explode(F.array(F.col("low").cast("double"), F.col("high").cast("double"))).alias("bound"))
    cuts = bounds.agg(F.percentile_approx("bound", [i / BANDS for i in range(BANDS + 1)], 100 * BANDS)).first()[0]
    if not cuts:
        return rows.select(*keys, F.lit(None).cast(rules.schema[result].dataType).alias(result))
    band = lambda name: _band(F.col(name).cast("double"), sorted(set(cuts)))
    cut = rules.withColumn("band", F.explode(F.sequence(band("low"), band("high"))))
    met = rows.withColumn("band", band(value)).join(small(cut), ["band"], "left")
    answer = F.max(F.when(F.col(value).between(F.col("low"), F.col("high")), F.struct("seq", result))).alias("last")
    return met.groupBy(*keys).agg(answer).select(*keys, F.col(f"last.{result}").alias(result))


def lookup_or(rows: DataFrame, table: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """``rows`` with the columns of ``table`` for their key, or the defaults."""
    return rows.join(table, key, "left").withColumns({name: F.coalesce(name, F.lit(value)) for name, value in defaults.items()})


def merged_registers(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join of two registers; numbers that one of them lacks are 0."""
    joined = a.join(b, key, "full")
    numbers = [name for name, kind in joined.dtypes if name != key and kind in ("int", "bigint", "double")]
    return joined.fillna(0, subset=numbers)


def berth_admission(rows: DataFrame) -> DataFrame:
    """``status`` and ``reasons`` of ships for berths: ``wind, sight, max_wind, min_sight, dwt, max_dwt, draught, depth``; what is unknown passes."""
    status, why = reasons(
        (F.col("wind") > F.col("max_wind"), "wind over limit"),
        (F.col("sight") < F.col("min_sight"), "visibility under limit"),
        (F.col("dwt") > F.col("max_dwt"), "tonnage over limit"),
        (F.col("draught") > F.col("depth"), "draught over depth"),
    )
    return rows.withColumns({"status": status, "reasons": why})


def bridge_passage(latest: DataFrame, holes: DataFrame, ships: DataFrame, weather: DataFrame) -> DataFrame:
    """Ships in the water before a bridge's holes: whether they approach, and whether they may pass.

    ``holes`` are polygons with ``hole_cog, max_length, closed``, ``weather`` is one row of ``wind, max_wind``.  A ship
    without a register entry has length 0.
    """
    near = points_in_polygons(latest, holes)
    near = lookup_or(near, ships, "mmsi", {"length": 0, "ship_name": "none"})
    wind, max_wind = weather.select("wind", "max_wind").first()
    status, why = reasons(
        (F.col("closed"), "hole closed"),
        (F.lit(wind) > F.lit(max_wind), "wind over limit"),
        (F.col("length") > F.col("max_length"), "length over limit"),
        (acute_difference("cog", "hole_cog") > 45, "course across the hole"),
    )
    return near.filter(approaching("cog", "hole_cog")).withColumns({"status": status, "reasons": why})


def nearest_channel_point(latest: DataFrame, channel: DataFrame) -> DataFrame:
    """The nearest point of a channel model whose course differs by less than 90 degrees; ``channel`` has ``channel_id, c_lon, c_lat, c_cog``."""
    gap = F.abs(F.col("cog") - F.col("c_cog"))
    found = nearest_by_rings(latest.select("mmsi", "lon", "lat", "cog"), channel, ["channel_id"], F.least(gap, 360 - gap) < 90, ("c_lon", "c_lat"))
    return found.filter("best is not null").select("mmsi", F.col("best.channel_id").alias("channel_id"), F.col("best.km").alias("channel_km"))


def sector_forecast(latest: DataFrame, lon: float, lat: float, radius_km: float, speed_kmh: Column) -> DataFrame:
    """Seconds until each ship enters and leaves a circle, for those whose course meets it."""
    km = haversine_km("lon", "lat", F.lit(lon), F.lit(lat))
    toward = compass_bearing("lon", "lat", F.lit(lon), F.lit(lat))
    rows = latest.withColumns({"km": km, "toward": toward})
    return rows.withColumn("s", sector_times("km", "toward", "cog", speed_kmh, F.lit(radius_km))).filter("s is not null").select("mmsi", F.col("s.enter").alias("enter_s"), F.col("s.leave").alias("leave_s"))


def slot_counts(forecast: DataFrame, slots: tuple[int, ...] = (1, 3, 5, 7, 9), slot_s: int = 600) -> DataFrame:
    """Ships of each type in the fixed slots that their stay touches, and who they are; ``forecast`` has ``mmsi, ship_type, enter_s, leave_s``."""
    touched = F.array_intersect(F.sequence(F.expr(f"enter_s div {slot_s}"), F.expr(f"leave_s div {slot_s}")), F.array(*[F.lit(s).cast("long") for s in slots]))
    rows = forecast.withColumn("slot", F.explode(touched))
    ships = F.array_join(F.transform(F.sort_array(F.collect_set("mmsi")), lambda x: x.cast("string")), ",")
    return rows.groupBy("ship_type", "slot").agg(F.count(F.lit(1)).alias("n"), ships.alias("ships"))
