"""Frequencies of questions over a stream of log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequency(stream: DataFrame, time: str = "received_at", column: str = "query_text", window: str = "1 day", late: str | None = "30 days") -> DataFrame:
    """Counts by window and text; rows later than ``late`` are dropped (None: the stream has its watermark), rows without a time or text
    are left out."""
    rows = stream.where(F.col(column).isNotNull() & F.col(time).isNotNull())
    rows = rows.withWatermark(time, late) if late else rows
    return rows.groupBy(F.window(time, window).alias("w"), F.col(column).alias("query_text")).count().select("w.start", "w.end", "query_text", "count")


def once_per_call(stream: DataFrame, key: str = "call_id", time: str = "received_at", late: str = "30 days") -> DataFrame:
    """Each call once, though it may be delivered again within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
