"""Check result, threshold and snapshot readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyops.operators.health import parse_results


def read_check_results(spark: SparkSession, path, now=None) -> DataFrame:
    """Files with one JSON object per check run."""
    return parse_results(spark.read.text(path), "value", now)


def stream_check_results(spark: SparkSession, path, now=None) -> DataFrame:
    return parse_results(spark.readStream.text(path), "value", now)


def read_thresholds(spark: SparkSession, path) -> DataFrame:
    """User thresholds as JSON lines (check, warning, critical)."""
    return spark.read.schema("check string, warning double, critical double").json(path)
