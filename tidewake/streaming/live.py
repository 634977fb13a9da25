"""Positions as a stream: latest position, counts in a circle, change detection, stops across batches, sinks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tidewake.functions.geo import haversine_km
from tidewake.operators.stops import MAX_DIAGONAL_MM, MAX_SPEED_MM_S, _Fold, _pair_km


def position_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int = 8) -> DataFrame:
    """Files dropped into a directory, as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(path)


def latest_in_window(stream: DataFrame, late: str = "10 minutes", width: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """The newest position of each ship in sliding windows of event time; ``stream`` has ``ts, mmsi, event_id, lon, lat``."""
    row = F.max(F.struct("ts", "event_id", "lon", "lat")).alias("row")
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width, every), "mmsi").agg(row).select(F.col("window.start").alias("window_start"), "mmsi", "row.*")


def circle_counts(stream: DataFrame, lon: float, lat: float, radius_km: float, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """How many ships were in a circle, per tumbling window, exactly: one state keeps each window's ships, a second one counts them once the window is past."""
    near = stream.withWatermark("ts", late).filter(haversine_km("lon", "lat", F.lit(lon), F.lit(lat)) < radius_km)
    ships = near.groupBy(F.window("ts", width), "mmsi").agg(F.count(F.lit(1)).alias("n_points"))
    counted = ships.groupBy(F.window(F.window_time("window"), width).alias("slot")).agg(F.count(F.lit(1)).alias("n_ships"), F.sum("n_points").alias("n_points"))
    return counted.select(F.col("slot.start").alias("window_start"), "n_ships", "n_points")


def visits(rows: DataFrame, gap: str) -> DataFrame:
    """Positions of a ship at a site less than ``gap`` apart; a session window also joins those exactly ``gap`` apart, so it is a microsecond shorter."""
    short = F.session_window("ts", f"{gap} -1 microseconds")
    end = F.col("session_window.end") + F.expr("interval 1 microsecond")
    return rows.groupBy("mmsi", "site", short).agg(F.count(F.lit(1)).alias("n_points")).select("mmsi", "site", F.col("session_window.start").alias("begin_ts"), end.alias("end_ts"), "n_points")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Visits of a ship to a site: positions less than ``gap`` apart."""
    return visits(stream.withWatermark("ts", late), gap)


def changed_only(stream: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first row for each value of ``keys`` within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


_STOP = "mmsi long, stop long, begin_t long, end_t long, point_num long"
_STATE = "fold string, waiting string"


class _Ship:
    """The scan of one ship between micro-batches: the fold's few numbers, the open stop, and the points that the watermark has not passed."""

    def __init__(self, max_speed: float, max_diagonal: float, state: tuple[str, str] | None):
        self.fold, self.begin, self.size, self.waiting = _Fold(max_speed, max_diagonal), None, 0, []
        if state is not None:
            self.waiting = json.loads(state[1])
            if state[0]:
                self.fold.stop, self.fold.open, box, last, self.begin, self.size = json.loads(state[0])
                self.fold.box, self.fold.last = tuple(box), tuple(last)

    def state(self) -> tuple[str, str]:
        f = self.fold
        numbers = json.dumps([f.stop, f.open, f.box, f.last, self.begin, self.size]) if f.last is not None else ""
        return numbers, json.dumps(self.waiting)

    def passed(self, until: float) -> list[tuple]:
        """Points no later than ``until`` go through the fold in order of time; the stops that end thereby."""
        ready = sorted(x for x in self.waiting if x[0] <= until)
        self.waiting = [x for x in self.waiting if x[0] > until]
        out, fold = [], self.fold
        if not ready:
            return out
        line = ([list(fold.last[1:])] if fold.last is not None else []) + [x[2:] for x in ready]
        km = _pair_km(np.array([x for x, _ in line]), np.array([y for _, y in line])).tolist() if len(line) > 1 else []
        km = km if fold.last is not None else [None, *km]
        for (t, _, lon, lat), d in zip(ready, km, strict=True):
            before, was_open, number = fold.last, fold.last is not None and fold.open, fold.stop
            fold.feed(t, lon, lat, d)
            if was_open and fold.stop != number:
                out.append((number, self.begin, before[0], self.size))
            if fold.open:
                same = was_open and fold.stop == number
                self.begin, self.size = (self.begin, self.size + 1) if same else (before[0], 2)
        return out

    def closed(self) -> list[tuple]:
        return [(self.fold.stop, self.begin, self.fold.last[0], self.size)] if self.fold.last is not None and self.fold.open else []


def stop_stream(stream: DataFrame, max_speed_mm_s: float = MAX_SPEED_MM_S, max_diagonal_mm: float = MAX_DIAGONAL_MM, late: str = "10 minutes", quiet_s: int | None = None) -> DataFrame:
    """Stops of each ship over all micro-batches, as the batch scan finds them, for points that come up to ``late`` out of order.

    The scan's few numbers are the state, so a stop goes on over midnight and over batches; points wait in it until the
    watermark has passed them and are then taken in order of time and ``event_id``.  A timer at the earliest
    waiting point wakes ships that send nothing more.  Points later than ``late`` are dropped by the watermark.  A stop is
    emitted once it has ended; with ``quiet_s`` also when the watermark is so many seconds past the ship's last point, and the ship
    starts afresh.  ``stream`` has ``mmsi, event_id, t, lon, lat`` with ``t`` in seconds.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ship = _Ship(max_speed_mm_s, max_diagonal_mm, state.get if state.exists else None)
        if not state.hasTimedOut:
            rows = pd.concat(list(frames))
            ship.waiting += [list(x) for x in zip(*[rows[c].tolist() for c in ("t", "event_id", "lon", "lat")], strict=True)]
        now = state.getCurrentWatermarkMs()
        out = ship.passed(now / 1000)
        wake = min((x[0] for x in ship.waiting), default=None)
        if wake is None and quiet_s is not None and ship.fold.last is not None:
            wake = ship.fold.last[0] + quiet_s
            if wake * 1000 <= now:
                out, wake = out + ship.closed(), None
        if wake is None and quiet_s is not None:
            state.remove()
        else:
            state.update(ship.state())
            if wake is not None:
                state.setTimeoutTimestamp(max(wake * 1000, now + 1))
        yield pd.DataFrame([(key[0], *x) for x in out], columns=["mmsi", "stop", "begin_t", "end_t", "point_num"])

    timed = stream.withColumn("_at", F.timestamp_seconds("t")).withWatermark("_at", late)
    return timed.groupBy("mmsi").applyInPandasWithState(step, _STOP, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def caught_up(frame: DataFrame, path: str, seen: str, fmt: str = "parquet") -> None:
    """What has arrived since the last call, appended below ``path``: the daily job of an outside scheduler; ``seen`` keeps what was read."""
    query = frame.writeStream.format(fmt).option("path", path).option("checkpointLocation", seen).trigger(availableNow=True).start()
    query.awaitTermination()
