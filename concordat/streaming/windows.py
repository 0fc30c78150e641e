"""Windowed counts over an event stream, the same for a stream and for a table. An extension: the reconciliation
itself is batch, and late data is a new revision.

Streams close a window once the watermark (greatest time less ``lateness``) has passed its end; rows
that come later are dropped and counted apart (``dropped``). Rows without a time are in no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _timed(events: DataFrame, lateness: str | None) -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", lateness) if events.isStreaming and lateness else timed


def _text(moment: Column, form: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(moment, form)


def hourly(events: DataFrame, lateness: str | None = "2 hours") -> DataFrame:
    """Events by hour and type."""
    grouped = _timed(events, lateness).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n_events"))
    return grouped.select(_text(F.col("window.start")).alias("window_start"), "event_type", "n_events")


def sliding(events: DataFrame, size: str = "1 hour", slide: str = "15 minutes", lateness: str | None = "2 hours") -> DataFrame:
    """Events by type in windows of a size that start at every slide; an event is in size / slide of them."""
    grouped = _timed(events, lateness).groupBy(F.window("ts", size, slide), "event_type").agg(F.count("*").alias("n_events"), F.max("value").alias("most"))
    return grouped.select(_text(F.col("window.start")).alias("window_start"), "event_type", "n_events", "most")


def sessions(events: DataFrame, gap: str = "30 minutes", by: str = "user_id", lateness: str | None = "2 hours") -> DataFrame:
    """Sessions of each user: events less than gap apart, with the session's first moment and its end, gap after the last."""
    grouped = _timed(events, lateness).groupBy(F.session_window("ts", gap), by).agg(F.count("*").alias("n_events"))
    exact = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return grouped.select(by, _text(F.col("session_window.start"), exact).alias("session_start"), _text(F.col("session_window.end"), exact).alias("session_end"), "n_events")


def dropped(query: StreamingQuery) -> int:
    """Rows of the recent micro-batches that came after their window had closed."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])
