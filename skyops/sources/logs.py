"""Log line and alert rule readers, batch and stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.operators.alerts import clean_rules
from skyops.schemas import ALERT_RULES


def read_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line; a missing path is an empty log."""
    try:
        return spark.read.text(path).select("value")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def stream_lines(spark: SparkSession, path: str, from_time: Column | None = None,
                 max_files: int | None = None) -> DataFrame:
    """Follow a folder of log files. ``from_time`` skips files written before it ("start at
    the end"); files must appear whole, so partial lines and rotation need no handling."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path)
    if from_time is not None:
        lines = lines.filter(F.col("_metadata.file_modification_time") >= from_time)
    return lines.select("value")


def read_alert_rules(spark: SparkSession, path) -> DataFrame:
    """Rules stored as JSON lines, with defaults applied and enums checked."""
    return clean_rules(spark.read.schema(ALERT_RULES).json(path))
