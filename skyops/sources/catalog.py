"""Catalog readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.schemas import QUERY_CATALOG, RAW_CATALOG, RAW_COLUMNS

CORRUPT = "_corrupt_record"


def read_catalog_json(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Arrays of objects (or JSON lines) to the raw columns plus ``_corrupt_record``.

    Unknown keys are dropped and absent ones are null. Values are read as text and cast here, so
    that one bad value marks its own row (as JSON) and not the whole document. One document is
    one task: large extracts should come as many files or as JSON lines (``multi_line=False``).
    """
    types = dict(part.split() for part in RAW_CATALOG.split(", "))
    text = (
        spark.read.schema(", ".join(f"{c} string" for c in [*types, CORRUPT]))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )

    def cast(c: str, t: str):
        if t == "string":
            return F.col(c)
        number = F.col(c).try_cast("double")
        return F.when(number == F.floor(number), number).cast("int") if t == "int" else number

    values = {c: cast(c, t) for c, t in types.items()}
    lost = F.lit(False)
    for c, v in values.items():
        lost = lost | (F.col(c).isNotNull() & v.isNull())
    bad = F.coalesce(F.col(CORRUPT), F.when(lost, F.to_json(F.struct(*types))))
    return text.select(*[v.alias(c) for c, v in values.items()], bad.alias(CORRUPT))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows with the raw columns, rows that did not parse)."""
    return (df.filter(F.col(CORRUPT).isNull()).select(*RAW_COLUMNS),
            df.filter(F.col(CORRUPT).isNotNull()))


def read_catalog_table(spark: SparkSession, path: str, fmt: str = "parquet",
                       **options) -> DataFrame:
    """The 13 query columns of a stored table; a missing table reads as an empty one."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.format(fmt).options(**options).load(path)
        return df.select(*[c.split()[0] for c in QUERY_CATALOG.split(", ")])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], QUERY_CATALOG)
