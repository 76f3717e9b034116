"""Run audit: one appended row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.schemas import RUNS


def run_row(spark: SparkSession, run: dict) -> DataFrame:
    columns = [c.split()[0] for c in RUNS.split(", ")]
    return spark.createDataFrame([tuple(run.get(c) for c in columns)], RUNS)


def append_runs(runs: DataFrame, table: str) -> None:
    runs.select(*[c.split()[0] for c in RUNS.split(", ")]).write.mode("append").parquet(table)


def append_run(spark: SparkSession, run: dict, table: str) -> None:
    append_runs(run_row(spark, run).coalesce(1), table)


def recent_runs(runs: DataFrame, count: int = 10) -> DataFrame:
    """Latest runs first; the run id breaks ties."""
    return runs.orderBy(F.desc("started_at"), "run_id").limit(count)


def with_duration(runs: DataFrame) -> DataFrame:
    """Seconds from start to completion, null while a run is open."""
    seconds = (F.unix_micros("completed_at") - F.unix_micros("started_at")) / 1e6
    return runs.withColumn("duration_seconds", seconds)
