"""Exact medians for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def median_by(df: DataFrame, by: Sequence[str], value: str, name: str = "median",
              extra: dict[str, Column] | None = None, accuracy: int = _ACCURACY) -> DataFrame:
    """Exact median per group, nulls ignored, plus any ``extra`` aggregates; never gathers a group.

    A mergeable quantile sketch gives two values that surely enclose the middle ranks. Everything
    below them becomes one count; the values between (some 4 / accuracy of the group) are
    counted by distinct value, and a running count over those few finds the two middle ranks. A
    group without values has a null median.
    """
    margin = 2.0 / accuracy
    around = F.percentile_approx(value, [0.5 - margin, 0.5 + margin], accuracy)
    groups = df.groupBy(*by).agg(
        F.count(value).alias("_n"), around.alias("_around"), *[c.alias(n) for n, c in (extra or {}).items()])
    if not by:
        return _median_of_all(df, groups, value, name)
    low, high = F.col("b._around")[0], F.col("b._around")[1]
    x, b = df.alias("x"), groups.alias("b")
    rows = x.join(b, same_keys("x", "b", by)).filter(F.col(f"x.{value}") <= high).select(
        *[F.col(f"x.{k}") for k in by], "_n",
        F.when(F.col(f"x.{value}") >= low, F.col(f"x.{value}")).alias("_v"))
    found = _middle_values(rows, by, name)
    g, m = groups.alias("g"), found.alias("m")
    return g.join(m, same_keys("g", "m", by), "left").select(
        *[F.col(f"g.{k}") for k in by], F.col(f"m.{name}"), *[F.col(f"g.{n}") for n in (extra or {})])


def _middle_values(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    counts = rows.groupBy(*by, "_n", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = counts.withColumn("_end", F.sum("_c").over(_upto(by, "_v")))
    hit = _middle(F.col("_end") - F.col("_c"), F.col("_end"), F.col("_n"))
    return ranked.filter(hit[0] | hit[1]).groupBy(*by).agg(
        ((F.max(F.when(hit[0], F.col("_v"))) + F.max(F.when(hit[1], F.col("_v")))) / 2).alias(name))


def _median_of_all(df: DataFrame, whole: DataFrame, value: str, name: str) -> DataFrame:
    """The same without keys: one row of bounds, read as scalars, so that nothing is joined."""
    low, high = (whole.select(F.col("_around")[k]).scalar() for k in (0, 1))
    v = F.col(value)
    rows = df.where(v <= high).select(whole.select("_n").scalar().alias("_n"), F.when(v >= low, v).alias("_v"))
    middle = _middle_values(rows, (), name).select(name).scalar()
    return whole.select(middle.alias(name), *[c for c in whole.columns if c not in ("_n", "_around")])


def _upto(by: Sequence[str], value: str):
    """Rows of a group up to the current one, nulls first."""
    return Window.partitionBy(*by).orderBy(F.asc_nulls_first(value)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)


def _middle(start: Column, end: Column, n: Column) -> list[Column]:
    """Whether ranks after ``start`` up to ``end`` hold the lower and the upper middle of ``n``."""
    return [(start < k) & (k <= end) for k in (F.floor((n + 1) / 2), F.floor(n / 2) + 1)]


def with_median(rows: DataFrame, by: Sequence[str], value: str, counted: Column, name: str) -> DataFrame:
    """Add the median of the ``counted`` values of each group to all its rows, by one sort.

    For groups of moderate size, such as the values of one pixel: a group is one window, which
    spills. Chained calls keep the partitioning and the order.
    """
    one = F.when(counted & F.col(value).isNotNull(), 1).otherwise(0)
    whole = Window.partitionBy(*by)
    rows = rows.withColumns({"_one": one, "_end": F.sum(one).over(_upto(by, value))})
    rows = rows.withColumn("_n", F.sum("_one").over(whole))
    hit = _middle(F.col("_end") - F.col("_one"), F.col("_end"), F.col("_n"))
    middle = (F.max(F.when(hit[0], F.col(value))).over(whole) + F.max(F.when(hit[1], F.col(value))).over(whole)) / 2
    return rows.withColumn(name, middle).drop("_one", "_end", "_n")
