"""Places of rows in the order of their group, by a range-partitioned sort and partition counts.

A window over a group needs the whole group in one task. Here a group spans as many tasks as the
sort gives it; what is gathered is one row for each group and partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.session import cut_lineage


def with_ranks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str = "rank", size: str = "n") -> DataFrame:
    """Add ``rank`` of each row in its group, from 0, nulls first, and ``size``, the rows of the group.

    Null keys are a group. Equal rows are told apart by their place in the input, so that they spread as well.
    """
    at = F.monotonically_increasing_id()
    place = cut_lineage(rows.withColumn("_at", at).orderBy(*keys, *order, "_at").withColumn("_at", at))
    part = F.shiftright("_at", 33)
    parts = place.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*[f"_key{i}" for i in range(len(keys))])
    earlier = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.withColumns({"_size": F.sum("_rows").over(whole), "_before": F.coalesce(earlier, F.lit(0))})
    same = part == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return place.join(starts, same).select(
        *rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(rank), F.col("_size").alias(size))


def slice_of(ordered: DataFrame, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` up to ``offset + limit`` of a sorted table, in its order.

    Only the partitions that hold them are looked into; no task gathers what comes before.
    """
    at = F.monotonically_increasing_id()
    place = cut_lineage(ordered.withColumn("_at", at))
    part = F.shiftright("_at", 33)
    parts = place.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # a row a partition
    starts = parts.withColumn("_before", F.coalesce(earlier, F.lit(0)))
    held = starts.where((F.col("_before") < offset + limit) & (F.col("_before") + F.col("_rows") > offset)).select("_part", "_before")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = place.join(held, part == F.col("_part")).where((rank >= offset) & (rank < offset + limit))
    return rows.orderBy("_at").select(*ordered.columns)
