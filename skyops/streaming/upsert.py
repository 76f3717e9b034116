"""Upsert of a stream into the bucketed catalog table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyops.operators import catalog, quality
from skyops.sinks import upsert
from skyops.streaming import run


def upsert_batches(table: str, run_id: str, now=None, **options) -> Callable[[DataFrame, int], None]:
    """Per-batch function: validate, transform and merge one micro-batch.

    Batch n is write n + 1 of the table, so repeating a batch changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        clean = catalog.transform(quality.valid_rows(batch))
        upsert.write_upsert(upsert.stamp(clean, run_id, now), table, batch_id + 1, **options)

    return write


def without_redelivered(raw: DataFrame, ids: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Rows that a source delivers again within ``delay`` are dropped; the state holds ids of that span alone."""
    return raw.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(ids))


def upsert_stream(raw: DataFrame, table: str, checkpoint: str, run_id: str, now=None,
                  **options) -> StreamingQuery:
    return run.each_batch(raw, upsert_batches(table, run_id, now), checkpoint, **options)
