"""Streaming forms: islands in time, running counts, de-duplication with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes") -> DataFrame:
    """Chains of events at most ``gap`` apart, as session windows (batch or stream)."""
    s = events.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return s.select(key, "n", "first_ts", "last_ts")


def stream_sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """The same on a stream: sessions are final once the watermark passes them, and their state goes."""
    return gap_sessions(events.withWatermark(ts, late), key, ts, gap)


def stream_dedup(events: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The first of equal keys within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, keys: list[str], ts: str = "ts", width: str = "1 hour", late: str | None = None) -> DataFrame:
    e = events.withWatermark(ts, late) if late else events
    t = e.groupBy(*keys, F.window(ts, width).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return t.select(*keys, F.col("w.start").alias("window_start"), "n", "total")
