"""Catalog exports: CSV, JSON lines and VOTable documents."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.functions.text import float_text
from skyops.schemas import EXPORT_COLUMNS, QUERY_CATALOG

# The VOTable document and its field list (name, datatype, arraysize, description).
VOTABLE_OPEN = (
    '<?xml version="1.0" encoding="UTF-8"?>',
    '<VOTABLE version="1.4" xmlns="http://www.ivoa.net/xml/VOTable/v1.4">',
    '  <RESOURCE name="exoplanet_archive">',
    '    <TABLE name="ps">',
)
VOTABLE_FIELDS = (
    ("pl_name", "char", "*", "Planet Name"),
    ("hostname", "char", "*", "Host Star Name"),
    ("discovery_method", "char", "*", "Discovery Method"),
    ("disc_year", "int", "", "Discovery Year"),
    ("orbital_period", "double", "", "Orbital Period [days]"),
    ("pl_rade", "double", "", "Planet Radius [Earth radii]"),
    ("pl_bmasse", "double", "", "Planet Mass [Earth masses]"),
    ("pl_eqt", "double", "", "Equilibrium Temperature [K]"),
    ("st_teff", "double", "", "Stellar Effective Temperature [K]"),
    ("st_rad", "double", "", "Stellar Radius [Solar radii]"),
    ("sy_dist", "double", "", "Distance [pc]"),
    ("ra", "double", "", "Right Ascension [deg]"),
    ("dec", "double", "", "Declination [deg]"),
)
VOTABLE_DATA = ("      <DATA>", "        <TABLEDATA>")
VOTABLE_CLOSE = ("        </TABLEDATA>", "      </DATA>", "    </TABLE>", "  </RESOURCE>",
                 "</VOTABLE>")


def export_columns(df: DataFrame) -> DataFrame:
    return df.select(*EXPORT_COLUMNS)


def write_csv(df: DataFrame, path: str) -> None:
    """Header row in every file; null is an empty field."""
    (export_columns(df).write.option("header", True).option("emptyValue", "")
     .option("escape", '"').mode("overwrite").csv(path))


def write_json(df: DataFrame, path: str) -> None:
    """One object per line with its null keys kept."""
    export_columns(df).write.option("ignoreNullFields", False).mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(QUERY_CATALOG).option("header", True)
            .option("escape", '"').csv(path))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUERY_CATALOG).json(path)


def xml_escape(c: Column) -> Column:
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def votable_rows(df: DataFrame) -> DataFrame:
    """One ``<TR>`` line per row; a null is an empty cell."""
    cells = []
    for name, datatype, _, _ in VOTABLE_FIELDS:
        text = float_text(F.col(name)) if datatype == "double" else F.col(name).cast("string")
        cells.append(F.concat(F.lit("<TD>"), F.coalesce(xml_escape(text), F.lit("")),
                              F.lit("</TD>")))
    return df.select(F.concat(F.lit("          <TR>"), *cells, F.lit("</TR>")).alias("value"))


def votable_head() -> list[str]:
    fields = [
        f'      <FIELD name="{n}" datatype="{t}"' + (f' arraysize="{a}"' if a else "")
        + f' description="{d}"/>'
        for n, t, a, d in VOTABLE_FIELDS
    ]
    return [*VOTABLE_OPEN, *fields, *VOTABLE_DATA]


def votable_lines(df: DataFrame) -> DataFrame:
    """Every partition becomes one whole document: head, its rows, tail."""
    head, tail = votable_head(), list(VOTABLE_CLOSE)

    def document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": head})
        yield from batches
        yield pd.DataFrame({"value": tail})

    return votable_rows(df).mapInPandas(document, "value string")


def write_votable(df: DataFrame, path: str) -> None:
    votable_lines(df).write.mode("overwrite").text(path)


def read_votable(spark: SparkSession, path: str) -> DataFrame:
    """Cells of every ``TR`` back to typed columns."""
    raw = (spark.read.format("xml").option("rowTag", "TR").option("ignoreNamespace", True)
           .schema("TD array<string>").load(path))
    types = dict(part.split() for part in QUERY_CATALOG.split(", "))
    return raw.select(*[
        F.when(F.col("TD")[i] != "", F.col("TD")[i]).try_cast(types[name]).alias(name)
        for i, (name, *_) in enumerate(VOTABLE_FIELDS)
    ])
