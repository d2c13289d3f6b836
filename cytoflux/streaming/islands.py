"""Islands on a stream with state of one's own: chains of events, final once the watermark has passed them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

OPEN = "first bigint, last bigint, n bigint, first_id string"


class _Chains(StatefulProcessor):
    """Open islands of a key, in microseconds; a timer at each one's end.  State of a key is as large as its islands within the watermark, not as its events."""

    def __init__(self, keys: list[str], gap_us: int) -> None:
        self.keys, self.gap = keys, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", OPEN)

    def _held(self) -> list[tuple]:
        return [tuple(x) for x in self.open.get()] if self.open.exists() else []

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spans = self._held()
        known = {s[1] for s in spans}
        for part in rows:
            if not len(part):
                continue
            at = part["event_us"].astype("int64")
            spans += list(zip(at, at, [1] * len(at), part["event_id"], strict=True))
        spans.sort(key=lambda s: (s[0], s[3]))
        merged: list[list] = []
        for s in spans:
            if merged and s[0] - merged[-1][1] <= self.gap:
                merged[-1][1] = max(merged[-1][1], s[1])
                merged[-1][2] += s[2]
            else:
                merged.append(list(s))
        self.open.put([(int(a), int(b), int(n), i) for a, b, n, i in merged])
        ends = {m[1] for m in merged}
        for t in known - ends:
            self.handle.deleteTimer(self._timer(t))
        for t in ends - known:
            self.handle.registerTimer(self._timer(t))
        return iter(())

    def _timer(self, last: int) -> int:
        return -(-(int(last) + self.gap) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs()
        held = self._held()
        done = [s for s in held if self._timer(s[1]) <= passed]
        left = [s for s in held if self._timer(s[1]) > passed]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        if done:
            cells = {k: [v] * len(done) for k, v in zip(self.keys, key, strict=True)}
            yield pd.DataFrame(cells | {"n": [s[2] for s in done], "first_us": [s[0] for s in done], "last_us": [s[1] for s in done], "first_id": [s[3] for s in done]})

    def close(self) -> None:
        pass


def stream_islands(events: DataFrame, keys: list[str], ts: str = "ts", gap_seconds: float = 1800, late: str = "1 hour", row_id: str | None = None) -> DataFrame:
    """Chains of events at most a gap apart: keys, n, first_ts, last_ts and, of the first event, ``first_id`` (of equals in time the least).

    An island comes out when the watermark passes its last event and the gap.  Events later than the watermark are dropped by Spark before they get here; however events are
    split into micro-batches, the islands are those of the batch (``islands_of``).  The session needs the RocksDB state store.
    """
    kind = events.schema[ts].dataType
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    us = F.unix_micros(F.col(ts))
    rows = events.withWatermark(ts, late).select(*keys, ts, us.alias("event_us"), (F.col(row_id).cast("string") if row_id else F.lit("")).alias("event_id"))
    schema = StructType([rows.schema[k] for k in keys]).add("n", "long").add("first_us", "long").add("last_us", "long").add("first_id", "string")
    found = rows.groupBy(*keys).transformWithStateInPandas(statefulProcessor=_Chains(keys, int(gap_seconds * 1_000_000)), outputStructType=schema, outputMode="append", timeMode="eventtime")
    return found.select(*keys, "n", F.timestamp_micros("first_us").cast(kind).alias("first_ts"), F.timestamp_micros("last_us").cast(kind).alias("last_ts"), "first_id")


def islands_of(events: DataFrame, keys: list[str], ts: str = "ts", gap_seconds: float = 1800, row_id: str | None = None) -> DataFrame:
    """The same in a batch, by the segmented islands of ``operators.intervals``."""
    from ..operators.intervals import islands

    d = events.select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("event_us"), (F.col(row_id).cast("string") if row_id else F.lit("")).alias("event_id"))
    gap = int(gap_seconds * 1_000_000)
    t = islands(d, keys, F.col("event_us"), ["event_id"], gap, segment_width=max(64 * gap, 1))
    g = t.groupBy(*keys, "island").agg(F.count("*").alias("n"), F.min("event_us").alias("a"), F.max("event_us").alias("b"), F.min_by("event_id", F.struct("event_us", "event_id")).alias("first_id"))
    kind = events.schema[ts].dataType
    return g.select(*keys, "n", F.timestamp_micros("a").cast(kind).alias("first_ts"), F.timestamp_micros("b").cast(kind).alias("last_ts"), "first_id")
