"""Ordered computations over long timelines, cut into time buckets so no task sees a whole key.

Spark's own window frames put every row of a key into one task, and a sliding frame is
re-aggregated for each row. The helpers below keep the exact result with bounded groups
and linear work, on two levels: running sums, or the last value, inside a bucket, and totals of
whole buckets carried to later ones. A bucket's width is chosen from the density of the data, so
that a dense hour of a single stream is many tasks; a window may span any number of buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
#: Times of a key in a bucket, at most; and the width of a bucket of sparse data, in windows.
TICKS = 500_000
WINDOWS_PER_BUCKET = 4
#: Rows that a task sorts, where their number is known.
ROWS = 250_000


def trailing_sums(df: DataFrame, keys: Sequence[str], ts: str, counts: dict[str, Column],
                  window_seconds: int) -> DataFrame:
    """For every distinct (keys, ts): the counts summed over [ts - window, ts], both ends in.

    Output: keys, ts, one column per count, and ``window_start`` (oldest time still inside).
    """
    us = F.unix_micros(ts)
    width, rows = bucket_plan(df, keys, us, int(window_seconds) * MICROS * WINDOWS_PER_BUCKET)
    return trailing_sums_of(ticks_of(df, keys, us, counts), keys, ts, list(counts), window_seconds, width, rows)


def trailing_sums_of(ticks: DataFrame, keys: Sequence[str], ts: str, names: Sequence[str],
                     window_seconds: int, width: int, rows: int | None = None) -> DataFrame:
    """``trailing_sums`` over ``ticks_of``, which several windows may share; ``rows``: how many ticks at most."""
    sums = sums_of(ticks, keys, names, int(window_seconds) * MICROS, width, rows)
    return sums.select(*keys, F.timestamp_micros("_us").alias(ts), *names,
                       F.timestamp_micros("_oldest").alias("window_start"))


def ticks_of(df: DataFrame, keys: Sequence[str], us: Column, counts: dict[str, Column]) -> DataFrame:
    """One row for each distinct (keys, us) with its counts: rows of equal time meet before any window."""
    return df.groupBy(*keys, us.alias("_us")).agg(*[c.alias(n) for n, c in counts.items()])


def bucket_width(df: DataFrame, keys: Sequence[str], us: Column, widest: int) -> int:
    """Microseconds of a bucket: ``widest``, less where the densest second of a key asks for it."""
    return bucket_plan(df, keys, us, widest)[0]


def bucket_plan(df: DataFrame, keys: Sequence[str], us: Column, widest: int) -> tuple[int, int]:
    """``bucket_width`` and the number of rows, by which the tasks are chosen.

    Ticks of a key are distinct microseconds, so no bucket holds more than ``TICKS`` of them. The
    rows of a second are counted by a map-side combined aggregate; two numbers reach the driver.
    """
    seconds = df.groupBy(*keys, F.floor(us / MICROS).alias("_second")).agg(F.count(F.lit(1)).alias("_n"))
    densest, rows = seconds.agg(F.max("_n"), F.sum("_n")).first()
    return max(TICKS, min(widest, TICKS * MICROS // (densest or 1))), rows or 0


def _by_bucket(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """Dealt to tasks by bucket: one for each ``ROWS``, or as Spark counts them where ``rows`` is not known.

    Without keys ``_h`` is a constant, which the windows and joins after it drop; dealt by it, rows would be dealt again.
    """
    tasks = [] if rows is None else [max(1, math.ceil(rows / ROWS))]
    return df.repartition(*tasks, *(["_h"] if keys else []), "_b")


def sums_of(ticks: DataFrame, keys: Sequence[str], names: Sequence[str], span: int, width: int,
            rows: int | None = None) -> DataFrame:
    """For every tick (keys, _us): the counts summed over [_us - span, _us], and ``_oldest``.

    Each tick enters the window at its time and leaves just after time + span; the running sum over
    those marks is the trailing sum, and the next to leave is the oldest inside. A bucket takes the
    sums of the buckets before it, and where nothing leaves in it any more, the first to leave after it.
    ``rows`` is the number of ticks at most, if known.
    """
    keys = list(keys)
    us = F.col("_us")

    def mark(at: Column, order: Column, sign: int, leaver: Column) -> Column:
        return F.struct(F.floor(at / width).alias("_b"), order.alias("_o"), F.lit(sign).alias("_sign"), leaver.alias("_leaver"))

    marks = ticks.select(*keys, _spread(keys).alias("_h"), "_us", *names, F.inline(F.array(
        mark(us, us * 2, 1, F.lit(None).cast("bigint")), mark(us + span, (us + span) * 2 + 1, -1, us))))
    signed = [(n, F.sum(F.col(n) * F.col("_sign"))) for n in names]
    totals = marks.groupBy("_h", "_b", *keys).agg(*[c.alias(f"_t_{n}") for n, c in signed], F.min("_leaver").alias("_first"))
    earlier = _over(["_h", *keys]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    later = _over(["_h", *keys]).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    # leavers ascend, so the first to leave later is the least of the later buckets
    carried = totals.select("_h", "_b", *keys, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_t_{n}") for n in names],
                            F.min("_first").over(later).alias("_first"))
    inside = _over(["_h", "_b", *keys])
    upto = inside.orderBy("_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by = ", ".join(f"`{k}`" for k in ["_h", "_b", *keys])
    oldest = F.expr(f"lead(_leaver) IGNORE NULLS OVER (PARTITION BY {by} ORDER BY _o)")
    local = _by_bucket(marks, keys, None if rows is None else 2 * rows).select(
        "_h", "_b", *keys, "_us", "_sign", *[c.over(upto).alias(n) for n, c in signed], oldest.alias("_oldest"))
    return _with_carried(local.filter("_sign = 1"), carried, keys).select(
        *[F.col(f"l.{k}") for k in keys], "l._us", *[(F.col(f"l.{n}") + F.col(f"r._t_{n}")).alias(n) for n in names],
        F.coalesce("l._oldest", "r._first").alias("_oldest"))


def bucketed_lag(df: DataFrame, keys: Sequence[str], order: Column, bucket: Column, value: Column,
                 name: str, count: int | None = None) -> DataFrame:
    """``lag(value)`` per key over a unique ``order``, with one task per (key, bucket).

    ``bucket`` must grow with ``order``. The first row of a bucket takes the last value of the
    nearest earlier non-empty bucket: those are one row per bucket, found by a max aggregate.
    The result is null only where the key has no earlier row or the earlier value is null.
    ``count`` is the number of rows at most, if known.
    """
    keys = list(keys)
    rows = df.withColumns({"_o": order, "_b": bucket, "_v": value, "_h": _spread(keys)})
    # bare values, where they are plain, are combined in a hash table instead of after a sort of all rows
    ends = rows.groupBy("_h", "_b", *keys).agg(F.max_by("_v", "_o").alias("_end"))
    carried = ends.select(
        "_h", "_b", *keys, F.struct(F.lag("_end").over(_over(["_h", *keys]).orderBy("_b")).alias("_v")).alias("_carry"))
    inside = _by_bucket(rows, keys, count).withColumn(
        "_prev", F.lag(F.struct("_v")).over(_over(["_h", "_b", *keys]).orderBy("_o")))
    return _with_carried(inside, carried, keys).select(
        *[F.col(f"l.{c}") for c in df.columns], F.coalesce("l._prev", "r._carry")["_v"].alias(name))


def _spread(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("bigint")


def _with_carried(local: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``l`` with what their bucket carries, ``r``.

    One exchange on (hash, bucket) serves both the window and the join; null keys compare inside.
    """
    left, right = local.alias("l"), carried.alias("r")
    same = (F.col("l._h") == F.col("r._h")) & (F.col("l._b") == F.col("r._b"))
    for k in keys:
        lk, rk = F.col(f"l.{k}"), F.col(f"r.{k}")
        # spelt as an interval so that it stays a condition and not a third join key
        same = same & ((lk.isNull() & rk.isNull())
                       | F.coalesce((lk <= rk) & (lk >= rk), F.lit(False)))
    return left.join(right, same, "left")


def _over(columns):
    return Window.partitionBy(*columns)


def time_bucket(ts: Column, seconds: float) -> Column:
    return F.floor(F.unix_micros(ts) / int(seconds * MICROS))
