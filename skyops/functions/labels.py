"""Metric label sets: maps are not groupable, sorted pair arrays are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_key(labels: Column) -> Column:
    """Canonical ``array<struct<key,value>>`` form of a label map, sorted by key."""
    return F.array_sort(F.map_entries(labels))


def format_labels(key: Column) -> Column:
    """``{a="1",b="2"}``, or an empty string for no labels."""
    pairs = F.transform(key, lambda p: F.concat(p["key"], F.lit('="'), p["value"], F.lit('"')))
    return F.when(F.coalesce(F.size(key), F.lit(0)) <= 0, F.lit("")).otherwise(
        F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    )


def with_label(key: Column, name: str, value: Column) -> Column:
    """Add one pair to a label key, keeping it sorted; an equal key is replaced."""
    pair = F.struct(F.lit(name).alias("key"), value.alias("value"))
    rest = F.filter(key, lambda p: p["key"] != name)
    return F.array_sort(F.array_append(rest, pair))
