"""Planned calls and passages against berths, weather and heights; the state of warnings over several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.text import reasons
from tidewake.operators.spatial import small

DEFAULT_DWT = 150_000


def is_morning(io_time: Column | str) -> Column:
    """Whether a planned time ``dd/hhmm`` is before noon; one that cannot be read counts as the afternoon."""
    clock = F.split_part(io_time if isinstance(io_time, Column) else F.col(io_time), F.lit("/"), F.lit(2))
    return F.coalesce(clock.try_cast("int") < 1200, F.lit(False))


def berth_tonnage(text: Column) -> Column:
    """``struct<low, high>`` of a berth's tonnage ``7-10万``, ``2.5-5万`` or ``2000-50000``; one figure alone is both; in tonnes.

    By decision the sign for ten thousand scales ranges alone: a single figure is taken as it stands.  What cannot be read is null.
    """
    plain = F.split(F.split_part(text, F.lit("万"), F.lit(1)), "-")
    unit = F.when(text.contains("万") & (F.size(plain) > 1), 10_000).otherwise(1)
    tonnes = lambda figure: (F.trim(figure).try_cast("double") * unit).try_cast("int")
    return F.struct(tonnes(plain[0]).alias("low"), tonnes(F.coalesce(F.try_element_at(plain, F.lit(2)), plain[0])).alias("high"))


def berth_names(text: Column) -> Column:
    """The berths of a plan, written ``a/b`` or short ``a1/2``: a part of digits alone takes the name before the digits of the first part."""
    parts = F.split(text, "/")
    name = F.regexp_extract(parts[0], r"^(.*?)[0-9]*$", 1)
    return F.transform(parts, lambda p: F.when(F.regexp_like(p, F.lit("^[0-9]+$")), F.concat(name, p)).otherwise(p))


def unjudged(rows: DataFrame, control: str, depart: str, today: Column, berth: str) -> DataFrame:
    """Rows with a berth that were not judged yet or have not left before ``today``."""
    open_ = (F.col(control) == 0) | (F.col(depart) >= today) | F.col(control).isNull()
    return rows.filter(open_ & F.col(berth).isNotNull())


def tonnage_class(plans: DataFrame, classes: DataFrame) -> DataFrame:
    """``plans`` with the ``dwt`` of the last class of their type and length, ``DEFAULT_DWT`` without one; ``classes`` has ``seq, class_type, min_len, max_len, class_dwt``."""
    same = (F.col("type") == F.col("class_type")) & F.col("length").between(F.col("min_len"), F.col("max_len"))
    met = plans.select("plan", "type", "length").join(small(classes), same, "left")
    found = met.groupBy("plan").agg(F.max_by("class_dwt", "seq").alias("class_dwt"))
    return plans.join(found, "plan").withColumn("dwt", F.coalesce("class_dwt", F.lit(DEFAULT_DWT))).drop("class_dwt")


def plan_berths(plans: DataFrame, berths: DataFrame) -> DataFrame:
    """``plan, suits, reason``: whether a ship fits the berths of its plan; the last of them decides, one that is unknown or of unknown tonnage does not suit.

    ``plans`` has ``plan, type, dwt, berths``, ``berths`` has ``berth, tonnage, berth_type``.
    """
    asked = plans.select("plan", "type", "dwt", F.posexplode_outer(berth_names(F.col("berths"))).alias("place", "berth"))
    met = asked.join(berths.withColumn("range", berth_tonnage(F.col("tonnage"))), "berth", "left")
    fits = F.col("dwt").between(F.col("range.low"), F.col("range.high")) & (F.col("type") == F.col("berth_type"))
    last = met.groupBy("plan").agg(F.max_by(F.coalesce(fits, F.lit(False)), F.coalesce("place", F.lit(0))).alias("suits"))
    return last.withColumn("reason", F.when(F.col("suits"), "").otherwise("ship does not suit the berth"))


def _half_day(morning: Column, name: str) -> Column:
    return F.when(morning, F.col(f"{name}_am")).otherwise(F.col(f"{name}_pm"))


def weather_checks(morning: Column) -> tuple[tuple[Column, str], ...]:
    """Failed checks of wind and visibility in the half of the day that a plan names."""
    return (
        (_half_day(morning, "wind") >= F.col("max_wind"), "wind over limit"),
        (_half_day(morning, "sight") <= F.col("min_sight"), "visibility under limit"),
    )


def height_check(morning: Column) -> tuple[Column, str]:
    """The failed check of a ship's height above the water of that half of the day."""
    return _half_day(morning, "water") + F.col("height") >= F.col("max_height"), "air draught over limit"


def plan_weather(plans: DataFrame) -> DataFrame:
    """``status, reasons`` of plans with ``io_time, max_wind, min_sight`` and the weather of both halves of the day."""
    status, why = reasons(*weather_checks(is_morning("io_time")))
    return plans.withColumns({"status": status, "reasons": why})


def air_draught(plans: DataFrame) -> DataFrame:
    """``status, reasons`` of plans with ``io_time, height, max_height, water_am, water_pm``."""
    status, why = reasons(height_check(is_morning("io_time")))
    return plans.withColumns({"status": status, "reasons": why})


def in_berth_wind(ships: DataFrame) -> DataFrame:
    """``status, reasons`` of ships at berth with ``berth_wind``: the wind has to stay below it, before and after noon."""
    status, why = reasons(
        (F.col("wind_am") >= F.col("berth_wind"), "leave before noon"),
        (F.col("wind_pm") >= F.col("berth_wind"), "leave after noon"),
    )
    return ships.withColumns({"status": status, "reasons": why})


def bridge_plan(plans: DataFrame) -> DataFrame:
    """``status, reasons`` of planned passages: tonnage, weather and height together; ``dwt, max_dwt`` and what the parts need."""
    morning = is_morning("io_time")
    status, why = reasons((F.col("dwt") >= F.col("max_dwt"), "tonnage over limit"), *weather_checks(morning), height_check(morning))
    return plans.withColumns({"status": status, "reasons": why})


def banded(value: Column, bands: list[tuple[float, float]]) -> Column:
    """The highest number of a band ``low <= value <= high``, 0 outside all of them."""
    level = F.lit(0)
    for number, (low, high) in enumerate(bands, 1):
        level = F.when(value.between(low, high), number).otherwise(level)
    return level


def newest_by_source(reports: DataFrame, *keys: str) -> DataFrame:
    """The newest report of each source; ``reports`` has ``source, t, report`` and the keys."""
    best = F.max(F.struct("t", "report", *[c for c in reports.columns if c not in ("source", "t", "report", *keys)])).alias("r")
    return reports.groupBy(*keys, "source").agg(best).select(*keys, "source", "r.*")


def warning_state(newest: DataFrame, keys: list[str], wind_bands, gust_bands, sight_bands, sources: int, speaker: str) -> DataFrame:
    """The worst level over all sources, and whether all of them confirmed it.

    A source's level is the worse one of its wind and its gusts.  ``speaker`` is the source whose
    visibility counts and whose level and name stand for a confirmation.  ``newest`` has ``source, wind,
    gust, sight, confirmed, level, by``.
    """
    suggested = F.greatest(banded(F.col("wind"), wind_bands), banded(F.col("gust"), gust_bands))
    spoken = F.col("source") == speaker
    out = newest.withColumn("suggested", suggested).groupBy(*keys).agg(
        F.max("suggested").alias("wind_level"),
        F.max(F.when(spoken, banded(F.col("sight"), sight_bands))).alias("sight_level"),
        F.max("wind").alias("worst_wind"), F.max("gust").alias("worst_gust"), F.min("sight").alias("worst_sight"),
        F.count_if(F.col("confirmed") == 1).alias("agreed"),
        F.max(F.when(spoken, F.col("level"))).alias("level"), F.max(F.when(spoken, F.col("by"))).alias("by"),
    )
    sure = F.col("agreed") == sources
    return out.select(
        *keys, "wind_level", F.coalesce("sight_level", F.lit(0)).alias("sight_level"), "worst_wind", "worst_gust", "worst_sight",
        sure.cast("int").alias("confirmed"), F.when(sure, F.col("level")).otherwise(0).alias("level"), F.when(sure, F.col("by")).otherwise("").alias("by"),
    )


def hole_counts(holes: DataFrame, passages: DataFrame) -> DataFrame:
    """Ships by hole, holes without one included, and ``alarm``: 1 where one of them may not pass, else 2."""
    met = passages.groupBy("polygon").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("status") == 2).cast("int")).alias("bad"))
    alarm = F.when(F.col("bad") == 1, 1).otherwise(2)
    return holes.select("polygon").join(met, "polygon", "left").select("polygon", F.coalesce("n", F.lit(0)).alias("n_ships"), alarm.alias("alarm"))
