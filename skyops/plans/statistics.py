"""Catalog statistics: total, by method, by year, parameter distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.operators import catalog


def statistics(df: DataFrame, parameters=catalog.PARAMETERS, method: str = "discovery_method",
               year: str = "disc_year") -> dict[str, DataFrame]:
    return {
        "total": catalog.total(df),
        "by_method": catalog.by_method(df, method),
        "by_year": catalog.by_year(df, year),
        "distributions": catalog.distributions(df, parameters),
    }


def statistics_long(df: DataFrame, parameters=catalog.PARAMETERS,
                    method: str = "discovery_method", year: str = "disc_year") -> DataFrame:
    """All four results as (section, item, count, min_val, max_val, mean_val), in one scan.

    Rows are first reduced to one record per (method, year) with map-side combination; the
    four sections are then folded from those few records.
    """
    cells = df.groupBy(F.col(method).alias("method"), F.col(year).alias("year")).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(F.col(p).cast("double")).alias(f"{tag}_{i}")
          for i, p in enumerate(parameters)
          for tag, f in (("lo", F.min), ("hi", F.max), ("sum", F.sum), ("cnt", F.count))],
    )

    def section(name, item, n, lo, hi, mean):
        return F.struct(F.lit(name).alias("section"), item.alias("item"), n.alias("n"),
                        lo.alias("lo"), hi.alias("hi"), mean[0].alias("total"),
                        mean[1].alias("cnt"))

    none = F.lit(None).cast("double")
    zero = F.lit(0).cast("long")
    rows = [section("total", F.lit("all"), F.col("n"), none, none, (none, zero)),
            section("by_method", F.col("method"), F.col("n"), none, none, (none, zero)),
            F.when(F.col("year").isNotNull(),
                   section("by_year", F.col("year").cast("string"), F.col("n"), none, none,
                           (none, zero)))]
    rows += [section("distribution", F.lit(p), zero, F.col(f"lo_{i}"), F.col(f"hi_{i}"),
                     (F.col(f"sum_{i}"), F.col(f"cnt_{i}")))
             for i, p in enumerate(parameters)]
    mean = F.try_divide(F.sum("total"), F.sum("cnt"))
    counted = F.col("section") != "distribution"
    return (
        cells.select(F.inline(F.array_compact(F.array(*rows))))
        .groupBy("section", "item")
        .agg(F.sum("n").alias("n"), F.round(F.min("lo"), 4).alias("min_val"),
             F.round(F.max("hi"), 4).alias("max_val"), F.round(mean, 4).alias("mean_val"))
        .select("section", "item", F.when(counted, F.col("n")).alias("count"),
                "min_val", "max_val", "mean_val")
    )
