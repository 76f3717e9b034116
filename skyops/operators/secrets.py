"""Line-wise secret scan over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.functions import secrets


def scan(documents: DataFrame, keys: Sequence[str], text: str = "text",
         patterns=secrets.PATTERNS) -> DataFrame:
    """(keys, line_number, pattern, severity, matched), one row per match.

    Texts without any telling word are dropped before they are split into lines, and lines the
    same way, so regular expressions run on suspicious lines only. No shuffle.
    """
    lines = (
        documents.filter(secrets.suspicious(F.col(text), patterns))
        .select(*keys, F.posexplode(F.split(text, "\n")).alias("_pos", "_line"))
        .filter(secrets.suspicious(F.col("_line"), patterns))
    )
    return lines.select(*keys, (F.col("_pos") + 1).cast("long").alias("line_number"),
                        F.inline(secrets.findings(F.col("_line"), patterns)))


def scan_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Scan a folder of text files; files with a NUL byte are binary and skipped."""
    docs = (spark.read.option("recursiveFileLookup", recursive).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))
    return scan(docs.filter(~F.contains("text", F.lit("\x00"))), ["file"])
