"""Connected components of links by large-star and small-star rounds, as joins and minima.

Each round links every node to the least node it sees; no step gathers the neighbours of a node,
and each round's links are written to the shared folder, so that a lost executor costs one round;
those of the round before are deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.session import cut_at, remove


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    found = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return found.where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the least id that it reaches.

    Links of an id to itself are ignored; without links the result is empty; null ids are dropped.
    """
    one_way = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, at = cut_at(one_way.distinct())
    before, now = None, _digest(links)
    while now != before:
        last = at
        links, at = cut_at(_small_star(_large_star(links)))
        remove(links.sparkSession, last)
        before, now = now, _digest(links)
    roots = links.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
