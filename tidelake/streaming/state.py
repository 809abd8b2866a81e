"""Stateful stream operators; all of them also accept batch frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.operators.temporal import interval_join


def stream_count(events: DataFrame, key: str) -> DataFrame:
    """Count per key over all time: the state keeps every key ever seen."""
    return events.groupBy(key).count()


def windowed_count(
    events: DataFrame,
    time: str,
    keys: Sequence[str],
    window: str = "10 seconds",
    watermark: str = "10 seconds",
) -> DataFrame:
    """Count per tumbling window and key; the watermark lets closed windows leave the state."""
    timed = events.withWatermark(time, watermark) if events.isStreaming else events
    return timed.groupBy(F.window(time, window), *keys).count()


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    within_seconds: int = 10,
    watermark: str = "10 seconds",
) -> DataFrame:
    """Stream-stream interval join: watermarks on both sides and a time range, so both states are evicted."""
    return interval_join(
        left.withWatermark(left_time, watermark),
        right.withWatermark(right_time, watermark),
        key,
        left_time,
        right_time,
        within_seconds,
    )
