"""Starting streams: file sinks, per-batch functions, and settings stateful operators need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State kept on local disk with changelogs in the checkpoint; needed by custom state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
             available_now: bool = True, interval: str = "1 second") -> StreamingQuery:
    """Append to files, exactly once through the checkpoint."""
    writer = stream.writeStream.outputMode("append").format(fmt).option(
        "checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start(path)


def each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", available_now: bool = True,
               interval: str = "1 second") -> StreamingQuery:
    """Call ``fn(batch, batch_id)``; it should be repeatable for the same id."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(fn).option(
        "checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query dropped because they came behind the watermark, as Spark counted them."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
