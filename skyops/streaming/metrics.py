"""Live counters, histograms and gauges, kept as bucketed tables of their latest values.

Each micro-batch is first reduced to one row a label set by an ordinary aggregate, which combines
before the shuffle; only those rows meet the stored values. What is stored is bounded by the label
sets, however many batches there were, and a batch that is repeated changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions.labels import format_labels
from skyops.sinks import upsert

GAUGES = "name string, label string, value double, resets boolean"


def latest_table(path: str, schema: str, keys: Sequence[str], buckets: int = upsert.BUCKETS) -> Callable[[DataFrame, int], None]:
    """A per-batch function that keeps the newest row of every key of update-mode output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert.write_upsert(batch, path, batch_id + 1, list(keys), schema, (), buckets)

    return write


def gauge_changes(samples: DataFrame, seq: str = "event_id") -> DataFrame:
    """What a batch does to each gauge: the value after its last ``set`` by (ts, seq), or the sum of its changes.

    Samples at or after the last set count, so the sums are taken for each set in two steps: the place of the last
    set of a label set, then the samples from there on.
    """
    rows = samples.select("name", format_labels(F.col("key")).alias("label"), "op", F.col("value").cast("double").alias("value"),
                          F.unix_micros("ts").alias("_us"), F.col(seq).alias("_seq"))
    is_set = F.col("op") == "set"
    # in two steps of plain numbers, which combine before the shuffle
    times = rows.where(is_set).groupBy("name", "label").agg(F.max("_us").alias("_last"))
    places = rows.where(is_set).join(times, ["name", "label"]).where("_us = _last").groupBy("name", "label", "_last").agg(F.max("_seq").alias("_at"))
    later = F.col("_last").isNull() | (F.col("_us") > F.col("_last")) | ((F.col("_us") == F.col("_last")) & (F.col("_seq") >= F.col("_at")))
    signed = F.when(F.col("op") == "dec", -F.col("value")).otherwise(F.col("value"))
    return rows.join(places, ["name", "label"], "left").where(later).groupBy("name", "label").agg(
        F.sum(signed).alias("value"), F.max(F.col("_last").isNotNull()).alias("resets"))


def gauge_table(path: str, seq: str = "event_id", buckets: int = upsert.BUCKETS) -> Callable[[DataFrame, int], None]:
    """A per-batch function that applies a batch of samples to the stored gauges."""

    def value(old: Column, new: Column) -> dict[str, Column]:
        before = F.when(new["resets"] | old.isNull(), 0.0).otherwise(old["value"])
        return {"value": before + new["value"]}

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert.write_upsert(gauge_changes(batch, seq), path, batch_id + 1, ["name", "label"], GAUGES, (), buckets, value)

    return write


def read_gauges(spark, path: str) -> DataFrame:
    return upsert.read_table(spark, path, GAUGES).drop("resets")
