"""Counters, gauges and histograms over sample rows, and their text exposition.

Samples are (name, labels map<string,string>, value double, ...); the label set is grouped in
its canonical sorted form, ``key``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions.labels import format_labels, label_key, with_label
from skyops.functions.text import float_text

# Default histogram bounds.
DEFAULT_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75,
                  1.0, 2.5, 5.0, 7.5, 10.0, math.inf)


def keyed(samples: DataFrame, labels: str = "labels") -> DataFrame:
    return samples.withColumn("key", label_key(F.col(labels)))


def counter(samples: DataFrame, by: Sequence[str] = ("name", "key"),
            amount: str = "value") -> DataFrame:
    """Sum of increments per label set. Negative increments are errors: see ``rejected``."""
    return (samples.filter(F.col(amount) >= 0).groupBy(*by)
            .agg(F.sum(amount).alias("value")))


def rejected(samples: DataFrame, amount: str = "value") -> DataFrame:
    """Increments a counter refuses."""
    return samples.filter(F.col(amount) < 0)


def gauge(samples: DataFrame, order: Sequence[str] = ("ts",), by: Sequence[str] = ("name", "key"),
          op: str = "op", value: str = "value") -> DataFrame:
    """Last ``set`` plus the ``inc`` / ``dec`` after it, per label set, in ``order``.

    The last set is a map-side-combined maximum; joining it back leaves only the rows that
    still count, which are then summed the same way. No ordered per-key fold is needed.
    """
    moment = F.struct(*order)
    last = samples.filter(F.col(op) == "set").groupBy(*by).agg(F.max(moment).alias("_set"))
    s, g = samples.alias("s"), last.alias("g")
    same = F.lit(True)
    for k in by:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"g.{k}"))
    rows = s.join(g, same, "left").select("s.*", "g._set")
    since = F.col("_set").isNull() | (moment >= F.col("_set"))
    signed = F.when(F.col(op) == "dec", -F.col(value)).otherwise(F.col(value))
    return (rows.filter(since).groupBy(*by).agg(F.sum(signed).alias("value")))


def bounds_of(bounds: Sequence[float] = DEFAULT_BOUNDS) -> list[float]:
    """Sorted, without repeats, infinity always present."""
    return sorted({float(b) for b in bounds} | {math.inf})


def histogram(samples: DataFrame, by: Sequence[str] = ("name", "key"), value: str = "value",
              bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Cumulative bucket counts (array, in bound order), sum and count in one aggregate."""
    v = F.col(value)
    counts = [F.count_if(v <= b) if not math.isinf(b) else F.count_if(~F.isnan(v))
              for b in bounds_of(bounds)]
    return samples.groupBy(*by).agg(F.array(*counts).alias("buckets"), F.sum(v).alias("sum"),
                                    F.count(v).alias("count"))


def histogram_buckets(hist: DataFrame, by: Sequence[str] = ("name", "key"),
                      bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """One row per bucket: ``le`` text and cumulative count."""
    labels = [bound_text(b) for b in bounds_of(bounds)]
    pairs = F.arrays_zip(F.array(*[F.lit(t) for t in labels]).alias("le"),
                         F.col("buckets").alias("cumulative"))
    return hist.select(*by, F.inline(pairs)).toDF(*by, "le", "cumulative")


def bound_text(b: float) -> str:
    return "+Inf" if math.isinf(b) else str(b)


# -- exposition ----------------------------------------------------------------------

def _line(pos: int | Column, *parts: Column) -> Column:
    return F.struct((F.lit(pos) if isinstance(pos, int) else pos).alias("pos"),
                    F.concat(*parts).alias("line"))


def _header(spark, block: int, name: str, help_text: str, kind: str, last: bool) -> DataFrame:
    rows = [(block, 0, 0, f"# HELP {name} {help_text}"), (block, 0, 1, f"# TYPE {name} {kind}")]
    if not last:
        rows.append((block, 2, 0, ""))
    return spark.createDataFrame(rows, "block int, part int, pos int, line string").select(
        "block", "part", F.array().cast(_KEY).alias("key"), "pos", "line")


_KEY = "array<struct<key:string,value:string>>"


def exposition(blocks: Sequence[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """Lines of a text exposition, one row each with its sort position.

    A block is (name, help, kind, values): counter and gauge values have (key, value), histogram
    values (key, buckets, sum, count) over ``DEFAULT_BOUNDS``.
    """
    out = None
    for i, (name, help_text, kind, values) in enumerate(blocks):
        label = format_labels(F.col("key"))
        if kind == "histogram":
            lines = [
                _line(n, F.lit(f"{name}_bucket"),
                      format_labels(with_label(F.col("key"), "le", F.lit(bound_text(b)))),
                      F.lit(" "), F.col("buckets")[n].cast("string"))
                for n, b in enumerate(bounds_of())]
            n = len(lines)
            lines += [_line(n, F.lit(f"{name}_sum"), label, F.lit(" "), float_text(F.col("sum"))),
                      _line(n + 1, F.lit(f"{name}_count"), label, F.lit(" "),
                            F.col("count").cast("string"))]
        else:
            lines = [_line(0, F.lit(name), label, F.lit(" "), float_text(F.col("value")))]
        body = values.select(F.lit(i).alias("block"), F.lit(1).alias("part"),
                             F.col("key").cast(_KEY).alias("key"), F.inline(F.array(*lines)))
        part = _header(values.sparkSession, i, name, help_text, kind, i == len(blocks) - 1)
        part = part.unionByName(body)
        out = part if out is None else out.unionByName(part)
    return out


def write_exposition(lines: DataFrame, path: str) -> None:
    """Sorted text files: reading them in name order gives the exposition."""
    (lines.orderBy("block", "part", "key", "pos").select(F.col("line").alias("value"))
     .write.mode("overwrite").text(path))


# -- access log ------------------------------------------------------------------------

def request_counts(access: DataFrame) -> DataFrame:
    """Requests per (method, endpoint, status)."""
    return access.groupBy("method", "endpoint", "status").agg(F.count(F.lit(1)).alias("requests"))


def request_latency(access: DataFrame, bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Latency histogram per (method, endpoint)."""
    return histogram(access, ("method", "endpoint"), "latency", bounds)
