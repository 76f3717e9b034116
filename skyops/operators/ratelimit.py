"""Sliding-window request limiting as an access-log analysis.

A hit is accepted when fewer than M *accepted* hits of its client lie in the last W seconds, so
each decision depends on the ones before: an ordered fold, not a window frame. Most hits need no
fold, though. Where at most M hits of any kind lie in (t - W, t], all of them are accepted; only
the hits within W before a fuller moment are *busy*. Runs of busy hits, cut at calm hits and
silences, are independent of each other and are the groups folded, so a task sees one client for
as long as it stays over the limit, and calm traffic is decided by window sums alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.operators.timeline import MICROS, WINDOWS_PER_BUCKET, bucket_width, bucketed_lag, sums_of, ticks_of
from skyops.session import cut_lineage

DEFAULT_MAX = 100
DEFAULT_WINDOW = 60


def fold(times: np.ndarray, ring: np.ndarray, filled: int, max_requests: int,
         span: int) -> tuple[np.ndarray, int]:
    """Accept flags for sorted times; ``ring`` holds the last accepted times, updated in place.

    ``filled`` counts all accepted hits so far; slot ``filled % max`` is the oldest of the last M.
    """
    ok = np.zeros(len(times), dtype=bool)
    for i, t in enumerate(times):
        slot = filled % max_requests
        if filled < max_requests or ring[slot] <= t - span:
            ring[slot] = t
            filled += 1
            ok[i] = True
    return ok, filled


def decide(access: DataFrame, client: str = "client", ts: str = "ts", order: str = "event_id",
           max_requests: int = DEFAULT_MAX, window_seconds: int = DEFAULT_WINDOW) -> DataFrame:
    """Add ``accepted`` to every hit; ties in time are decided in ``order``.

    Busy rows are streamed to the fold in time order by a partition sort; the fold keeps M times
    in memory, never the rows of a run.
    """
    span = window_seconds * MICROS
    runs = busy_runs(access, client, ts, max_requests, span)
    a, r = access.withColumn("_us", F.unix_micros(ts)).alias("a"), runs.alias("r")
    same = F.col(f"a.{client}").eqNullSafe(F.col(f"r.{client}")) & (
        F.col("a._us") == F.col("r._us"))
    rows = a.join(r, same, "left").select("a.*", "r._session")
    schema = access.schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ring, filled = None, np.empty(max_requests, dtype=np.int64), 0
        for pdf in batches:
            flags = np.zeros(len(pdf), dtype=bool)
            keys = list(zip(pdf[client], pdf["_session"]))
            times = pdf["_us"].to_numpy()
            start = 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[start]:
                    if keys[start] != current:
                        current, filled = keys[start], 0
                    flags[start:end], filled = fold(times[start:end], ring, filled,
                                                    max_requests, span)
                    start = end
            yield pdf[schema.names].assign(accepted=flags)

    calm = rows.filter(F.col("_session").isNull()).select(
        *schema.names, F.lit(True).alias("accepted"))
    busy = (rows.filter(F.col("_session").isNotNull())
            .repartition(client, "_session")
            .sortWithinPartitions(client, "_session", "_us", order)
            .select(*schema.names, "_us", "_session"))
    return calm.unionByName(busy.mapInPandas(run, ", ".join(fields) + ", accepted boolean"))


def busy_runs(access: DataFrame, client: str, ts: str, max_requests: int,
              span: int) -> DataFrame:
    """(client, _us, _session) of the busy moments: within a window before one with more than M
    hits. Two window sums, the second looking ahead by running on negated time."""
    moments = ticks_of(access, [client], F.unix_micros(ts), {"_n": F.count(F.lit(1))})
    width = bucket_width(access, [client], F.unix_micros(ts), span * WINDOWS_PER_BUCKET)
    hits = sums_of(moments, [client], ["_n"], span - 1, width)
    full = (F.col("_n") > max_requests).cast("int")
    back = cut_lineage(hits.select(client, (-F.col("_us")).alias("_us"), full.alias("_full")))
    ahead = sums_of(back, [client], ["_full"], span - 1, width)
    ticks = ahead.select(client, (-F.col("_us")).alias("_us"),
                         (F.col("_full") > 0).alias("_busy"))
    bucket = F.floor(F.col("_us") / width)
    seen = bucketed_lag(ticks, [client], F.col("_us"), bucket, F.struct("_us", "_busy"), "_before")
    fresh = (F.col("_before").isNull() | ~F.col("_before._busy")
             | (F.col("_us") - F.col("_before._us") >= span))
    busy = seen.filter("_busy").select(client, "_us",
                                       F.when(fresh, F.col("_us")).alias("_start"))
    return _carry_start(busy, client, bucket).select(client, "_us", "_session")


def _carry_start(rows: DataFrame, client: str, bucket) -> DataFrame:
    """Give every moment the start of its run: the latest start at or before it."""
    rows = rows.withColumn("_b", bucket)
    ends = rows.groupBy(client, "_b").agg(F.max("_start").alias("_latest"))
    so_far = Window.partitionBy(client).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(client, "_b", F.max("_latest").over(so_far).alias("_carry"))
    inside = Window.partitionBy(client, "_b").orderBy("_us").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.max("_start").over(inside))
    a, c = local.alias("a"), carried.alias("c")
    same = (F.col(f"a.{client}").eqNullSafe(F.col(f"c.{client}"))
            & (F.col("a._b") == F.col("c._b")))
    return (a.join(c, same, "left").select("a.*", "c._carry")
            .withColumn("_session", F.coalesce("_local", "_carry")))
