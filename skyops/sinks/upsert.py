"""Idempotent upsert on a key, as a pure function and into a Parquet table of key buckets.

The table is partitioned by a hash of the key. A write reads and replaces only the buckets that its
rows meet (dynamic partition overwrite), so its cost follows the batch and not the table. Each row
keeps the number of the write that made it: a write that is repeated, or comes after a later one,
finds its rows there and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.schemas import STORED_CATALOG
from skyops.session import cut_lineage

#: Buckets of a new table; a large one needs as many as its size over what a task may hold.
BUCKETS = 16


def stamp(rows: DataFrame, run_id: str, now: Column | None = None) -> DataFrame:
    """Add run id and both timestamps to freshly transformed rows."""
    now = F.current_timestamp() if now is None else now
    return rows.withColumns({"run_id": F.lit(run_id), "ingested_at": now, "updated_at": now})


def merge(existing: DataFrame, incoming: DataFrame, key: str = "pl_name",
          keep: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing``, nulls included; ``keep`` columns stay.

    Both sides are unique on the key, so the one full outer join has no hot key.
    """
    old, new = existing.alias("old"), incoming.alias("new")
    hit = F.col(f"new.{key}").isNotNull()
    columns = []
    for c in existing.columns:
        if c in keep:
            value = F.coalesce(F.col(f"old.{c}"), F.col(f"new.{c}"))
        else:
            value = F.when(hit, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        columns.append(value.alias(c))
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer").select(*columns)


def last_by_key(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Several rows of one key arrive in one batch: the last one counts."""
    columns = [c for c in rows.columns if c != ordinal]
    return (rows.groupBy(key).agg(F.max_by(F.struct(*columns), ordinal).alias("_row"))
            .select("_row.*"))


def bucket_of(key: str | list[str], buckets: int) -> Column:
    keys = [key] if isinstance(key, str) else key
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, table: str, schema: str = STORED_CATALOG) -> DataFrame:
    """The rows of a table; a missing one is empty. ``_seq`` and ``_bucket`` are left out."""
    return _stored(spark, table, schema).drop("_seq", "_bucket")


def _stored(spark: SparkSession, table: str, schema: str) -> DataFrame:
    whole = f"{schema}, _seq bigint, _bucket int"
    try:
        return spark.read.schema(whole).parquet(table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def write_upsert(incoming: DataFrame, table: str, seq: int, key: str | list[str] = "pl_name", schema: str = STORED_CATALOG,
                 keep: tuple[str, ...] = ("ingested_at",), buckets: int = BUCKETS,
                 combine: Callable[[Column, Column], dict[str, Column]] | None = None) -> list[int]:
    """Merge ``incoming``, unique by key, into the table as write number ``seq``; returns the buckets rewritten.

    ``combine(old, new)`` may give values that depend on both rows; ``old`` is null where there is none. All writes
    of a table use the same number of buckets. The folders of the buckets are swapped after all their files are written.
    """
    keys = [key] if isinstance(key, str) else key
    names = [c.split()[0].strip("`") for c in _columns(schema)]
    spark = incoming.sparkSession
    spark.createDataFrame([], f"{schema}, _seq bigint, _bucket int").write.mode("ignore").partitionBy("_bucket").parquet(table)
    new = cut_lineage(incoming.select(*names).withColumns({"_seq": F.lit(seq).cast("bigint"), "_bucket": bucket_of(keys, buckets)}))
    touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    old = _stored(spark, table, schema).where(F.col("_bucket").isin(touched))
    o, n = old.select(F.struct(*names, "_seq").alias("o"), *[F.col(k).alias(f"_o_{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_ob")), \
        new.select(F.struct(*names, "_seq").alias("n"), *[F.col(k).alias(f"_n_{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_nb"))
    same = F.col("_ob") == F.col("_nb")
    for i in range(len(keys)):
        same = same & F.col(f"_o_{i}").eqNullSafe(F.col(f"_n_{i}"))
    both = o.join(n, same, "full_outer")
    fresh = F.col("n").isNotNull() & (F.col("o").isNull() | (F.col("o._seq") < F.col("n._seq")))
    given = combine(F.col("o"), F.col("n")) if combine else {}
    values = {c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep else given.get(c, F.col(f"n.{c}")) for c in names}
    merged = both.select(*[F.when(fresh, values.get(c, F.col(f"n.{c}"))).otherwise(F.col(f"o.{c}")).alias(c) for c in [*names, "_seq"]],
                         F.coalesce("_nb", "_ob").alias("_bucket"))
    # stored before the swap, so that nothing is read from folders that are being replaced
    (cut_lineage(merged).repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_bucket").parquet(table))
    return touched


def _columns(schema: str) -> list[str]:
    """The columns of a schema text, whose types may hold commas."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def seed_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """The rows to insert: all of ``seed`` when ``target`` has no row, else none; decided when the query runs."""
    return seed.where(~target.select(F.lit(1)).exists())
