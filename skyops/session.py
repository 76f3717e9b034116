"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # {**a, **b}: the right-hand map wins on equal keys
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
#: Removes the shuffle files of an execution at its end. Only for writes: a DataFrame that is run again would shuffle again.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: By session: the setting from before, and how many threads write.
_WRITING: dict[str, tuple[str | None, int]] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options every operator assumes; safe to call again."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir() + "/skyops"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so retries restart from the files."""
    return cut_at(df)[0]


def cut_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``cut_lineage`` and the folder of its files, for ``remove`` once nothing reads them any more.

    The shuffle files of the write go when it ends; without that they stay until the driver collects its garbage.
    """
    path = scratch_dir(df.sparkSession, "stage")
    with _shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Sets ``_RELEASE`` until the last thread of the session that is inside leaves."""
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        before, n = _WRITING.get(session) or (spark.conf.get(_RELEASE, None), 0)
        _WRITING[session] = before, n + 1
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        with _LOCK:
            before, n = _WRITING.pop(session)
            if n > 1:
                _WRITING[session] = before, n - 1
            elif before is None:
                spark.conf.unset(_RELEASE)
            else:
                spark.conf.set(_RELEASE, before)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete working folders of ``cut_at``."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut_lineage`` plus the number of rows, counted by the same write."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return stored, seen.get["n"]


def cut_and_total(df: DataFrame, value: Column, wanted: Column) -> tuple[DataFrame, float]:
    """``cut_lineage`` of the ``wanted`` rows plus the sum of ``value`` over all rows, taken by the same write."""
    seen = Observation()
    stored = cut_lineage(df.observe(seen, F.sum(value).alias("total")).where(wanted))
    return stored, seen.get["total"] or 0.0
