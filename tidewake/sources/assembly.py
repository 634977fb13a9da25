"""Messages of several sentences put together over a feed in which sequence numbers come back.

A reader keeps, for each receiver, channel, sequence number and number of parts, the parts that wait.  A part that
repeats the last one of its number is an echo and is passed over.  A part whose place is taken means that the waiting
message lost one, so the wait starts afresh with it.  When all places are taken the message is complete.  A gap of more
than ``limit`` between sentences of one key ends the wait.  Parts may come in any order.

Over a table the same reading is done in parallel: the feed is cut into slices of ``width`` and at gaps, so that no wait crosses
a group, and each group is read in order by one task.  A stream keeps the waiting parts as state, and the watermark drops
those that stay unfinished.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewake.functions.text import parsed_once
from tidewake.operators.slices import homed

LIMIT, SLICE = 60, 86_400
KEY = ["receiver", "channel", "sequence", "parts"]


class Waiting:
    """The parts of one key that wait, and the last body of each part."""

    def __init__(self, parts: int, limit: float, last_at: float | None = None, held: dict[int, str] | None = None, last: dict[int, str] | None = None):
        self.parts, self.limit, self.last_at = parts, limit, last_at
        self.held, self.last = dict(held or {}), dict(last or {})

    def feed(self, at: float, part: int, body: str) -> str | None:
        """The whole message, if this part completes it."""
        if self.last_at is not None and at - self.last_at > self.limit:
            self.held, self.last = {}, {}
        self.last_at = at
        if self.last.get(part) == body:
            return None
        self.last[part] = body
        if part in self.held:
            self.held = {}
        self.held[part] = body
        if len(self.held) < self.parts:
            return None
        whole = "".join(self.held[i] for i in range(1, self.parts + 1))
        self.held = {}
        return whole


def sentences(datagrams: DataFrame, order: str = "at", value: str = "value") -> DataFrame:
    """The lines of datagrams that hold several, numbered as ``line_no`` within one ``order``."""
    lines = datagrams.select("*", F.posexplode(F.split(value, "\r?\n")).alias("line_no", "line")).drop(value)
    return lines.filter("line <> ''").withColumnRenamed("line", value)


def fields(lines: DataFrame, at: Column, value: str = "value", receiver: str | None = None, carried: list[str] | None = None) -> DataFrame:
    """The parts of ``!AIVDM`` and ``!AIVDO`` sentences; others, and those whose numbers make no sense, are left out."""
    number = F.col("line_no").cast("long") if "line_no" in lines.columns else F.lit(0).cast("long")
    f = F.col("_fields")
    rows = parsed_once(lines.filter(F.col(value).rlike("^!AIVD[MO],")), _fields=F.split(value, ",")).filter(F.size(f) >= 6).select(
        *(carried or []), (F.col(receiver).cast("string") if receiver else F.lit("")).alias("receiver"), F.get(f, F.lit(4)).alias("channel"), F.get(f, F.lit(3)).alias("sequence"),
        F.get(f, F.lit(1)).try_cast("int").alias("parts"), F.get(f, F.lit(2)).try_cast("int").alias("part"), F.get(f, F.lit(5)).alias("body"), at.alias("at"), number.alias("line_no"),
    )
    return rows.filter("part between 1 and parts and parts <= 9").fillna("", ["receiver"])


def _read(parts: int, limit: float, rows: Iterable[tuple]) -> Iterator[tuple[float, str]]:
    waiting = Waiting(parts, limit)
    for at, part, body in rows:
        whole = waiting.feed(at, part, body)
        if whole is not None:
            yield at, whole


def _frame(columns: dict[str, list], **kinds: str) -> pd.DataFrame:
    """Columns with stated types, so that an empty frame has them as well."""
    return pd.DataFrame({name: pd.Series(values, dtype=kinds.get(name, "object")) for name, values in columns.items()})


def assembled(lines: DataFrame, order: str = "at", value: str = "value", limit: float = LIMIT, width: float = SLICE, receiver: str | None = None) -> DataFrame:
    """``receiver, at, payload`` of every complete message of a feed, ``at`` that of the sentence which completed it.

    ``order`` is a number that grows along the feed, seconds for instance, in the unit of ``limit`` and ``width``.
    """
    rows = fields(lines, F.col(order).cast("double"), value, receiver)
    whole = rows.filter("parts = 1").select("receiver", "at", F.col("body").alias("payload"))

    def read(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(name, "ascending") for name in ("at", "line_no", "part", "body")])
        found = list(_read(int(key[3].as_py()), limit, zip(table["at"].to_numpy().tolist(), table["part"].to_pylist(), table["body"].to_pylist(), strict=True)))
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.string()), pa.array([a for a, _ in found], pa.float64(), from_pandas=True), pa.array([p for _, p in found], pa.string())], ["receiver", "at", "payload"])

    apart = lambda before: F.col("at") - before("at") > limit
    joined = homed(rows.filter("parts > 1"), KEY, "at", ["at", "line_no", "part", "body"], apart, width).groupBy(*KEY, "home").applyInArrow(read, "receiver string, at double, payload string")
    return whole.unionByName(joined)


def assembled_stream(stream: DataFrame, time: str = "ts", value: str = "value", limit_s: float = LIMIT, late: str = "1 minute", receiver: str | None = None) -> DataFrame:
    """``receiver, ts, payload`` of every complete message of a stream; sentences of one batch are taken in order of ``time``."""
    marked = stream.withWatermark(time, late)
    rows = fields(marked, F.unix_micros(time) / F.lit(1e6), value, receiver, [F.col(time).alias("ts")])
    whole = rows.filter("parts = 1").select("receiver", "ts", F.col("body").alias("payload"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        if state.hasTimedOut:
            state.remove()
        else:
            waiting = Waiting(int(key[3]), limit_s)
            if state.exists:
                at, held = state.get
                kept = json.loads(held)
                waiting = Waiting(waiting.parts, limit_s, at, *({int(k): v for k, v in x.items()} for x in kept))
            frame = pd.concat(list(frames)).sort_values(["at", "line_no", "part", "body"])
            for at, part, body, ts in zip(frame["at"].tolist(), frame["part"].tolist(), frame["body"].tolist(), frame["ts"].tolist(), strict=True):
                payload = waiting.feed(at, part, body)
                if payload is not None:
                    out.append((key[0], ts, payload))
            state.update((float(waiting.last_at), json.dumps([waiting.held, waiting.last])))
            state.setTimeoutTimestamp(max(int((waiting.last_at + limit_s) * 1000), state.getCurrentWatermarkMs()) + 1)
        yield _frame({"receiver": [x[0] for x in out], "ts": [x[1] for x in out], "payload": [x[2] for x in out]}, ts="datetime64[ns]")

    joined = rows.filter("parts > 1").groupBy(*KEY).applyInPandasWithState(step, "receiver string, ts timestamp, payload string", "at double, held string", "append", GroupStateTimeout.EventTimeTimeout)
    return whole.unionByName(joined)
