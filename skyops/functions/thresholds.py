"""Comparison operators given as data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operator spellings, and the tolerance of "==".
OPERATORS = (">", "<", ">=", "<=", "==")
EQUAL_TOLERANCE = 1e-9


def compare(op: Column, value: Column, threshold: Column) -> Column:
    """Evaluate ``value op threshold`` row by row; NaN never satisfies a comparison."""
    both = ~F.isnan(value) & ~F.isnan(threshold)
    return both & (
        F.when(op == ">", value > threshold)
        .when(op == "<", value < threshold)
        .when(op == ">=", value >= threshold)
        .when(op == "<=", value <= threshold)
        .when(op == "==", F.abs(value - threshold) < EQUAL_TOLERANCE)
        .otherwise(F.lit(None).cast("boolean"))
    )
