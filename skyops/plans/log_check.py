"""One-shot log check: parse, summarise the last window, evaluate the rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.operators import alerts, logs


def log_check(lines: DataFrame, rules: Sequence[dict], as_of: Column,
              parser=None) -> DataFrame:
    """Breached rules over the window that ends at ``as_of``; an empty result means healthy.

    Each rule looks at its own window; later entries do not count. An empty window has zero counts and rates, so
    "less than" rules can fire on silence.
    """
    spark = lines.sparkSession
    entries = logs.parse(lines, parser, as_of=as_of)
    entries = entries.where(F.col("ts") <= as_of)
    out = None
    for w in sorted({int(r.get("window_seconds", logs.DEFAULT_WINDOW)) for r in rules}):
        mine = [r for r in rules if int(r.get("window_seconds", logs.DEFAULT_WINDOW)) == w]
        since = F.timestamp_micros(F.unix_micros(as_of) - w * 1_000_000)
        stats = logs.rolling_stats(entries, since=since).withColumn("ts", as_of)
        part = alerts.evaluate(stats, alerts.rules_frame(spark, mine), ["ts"])
        out = part if out is None else out.unionByName(part)
    return (out.filter("breached").drop("breached").withColumn("state", F.lit("firing"))
            .withColumn("message", alerts.message()))
