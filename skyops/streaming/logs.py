"""Sliding log statistics on a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyops.operators import logs
from skyops.streaming import run

_NAMES = logs.COUNTERS


def sliding_stats(entries: DataFrame, keys: Sequence[str] = (), window_seconds: int = 300,
                  slide_seconds: int = 60, delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Counters and rates of every window [start, start + N), emitted once its end has passed.

    A row belongs to N / slide windows. It is therefore first counted into panes of one slide,
    and only panes are copied to their windows. Rows later than ``delay`` are dropped.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    slide = f"{slide_seconds} seconds"
    panes = (
        entries.withWatermark(ts, delay)
        .groupBy(*keys, F.window(ts, slide).alias("_pane"))
        .agg(*[c.alias(n) for n, c in logs.level_counts().items()],
             F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    windows = panes.groupBy(
        *keys, F.window(F.window_time("_pane"), f"{window_seconds} seconds", slide).alias("window")
    ).agg(*[F.sum(n).alias(n) for n in _NAMES], F.min("_first").alias("window_start"),
          F.max("_last").alias("window_end"))
    return logs.with_rates(windows)


def sliding_stats_batch(entries: DataFrame, keys: Sequence[str] = (), window_seconds: int = 300,
                        slide_seconds: int = 60, ts: str = "ts") -> DataFrame:
    """The same windows over a table."""
    panes = entries.groupBy(*keys, F.window(ts, f"{slide_seconds} seconds").alias("_pane")).agg(
        *[c.alias(n) for n, c in logs.level_counts().items()],
        F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    windows = panes.groupBy(
        *keys, F.window(F.col("_pane.start"), f"{window_seconds} seconds",
                        f"{slide_seconds} seconds").alias("window")
    ).agg(*[F.sum(n).alias(n) for n in _NAMES], F.min("_first").alias("window_start"),
          F.max("_last").alias("window_end"))
    return logs.with_rates(windows)


def on_entry(entries: DataFrame, callback: Callable[[DataFrame, int], None],
             checkpoint: str, **options) -> StreamingQuery:
    """Hand every micro-batch of entries to ``callback(entries, batch_id)``."""
    return run.each_batch(entries, callback, checkpoint, **options)
