"""Configuration audit: resolve, validate, compare, and look for drift and secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.operators import configs, secrets
from skyops.session import cut_lineage


def config_audit(nodes: DataFrame, parents: DataFrame, schema: dict, pairs: DataFrame,
                 documents: DataFrame | None = None) -> dict[str, DataFrame]:
    """Resolved trees, inheritance errors, violations, diffs of (env, base) pairs, drift.

    The resolved trees feed every later step, so they are stored once in the shared folder.
    """
    spark = nodes.sparkSession
    trees, errors = configs.resolve(nodes, parents)
    trees = cut_lineage(configs.with_roots(trees))
    left = (pairs.join(trees.withColumnRenamed("env", "base"), "base")
            .select("env", "path", "kind", "value"))
    right = trees.join(pairs.select("env"), "env", "left_semi")
    envs = trees.select("env").distinct()
    matrix = configs.version_matrix(configs.inventory(trees))
    out = {
        "trees": trees,
        "errors": errors,
        "violations": configs.violations(trees, configs.schema_rules(spark, schema)),
        "diff": configs.diff(left, right, ["env"]),
        "drift": configs.drift(matrix, envs),
        "runtime": configs.runtime_versions(trees),
    }
    if documents is not None:
        out["secrets"] = secrets.scan(documents, [c for c in documents.columns if c != "text"])
    return out


def one_diff(trees: DataFrame, left: str, right: str) -> DataFrame:
    """Diff of two named environments of one tree set, in path order."""
    a = trees.filter(F.col("env") == left).drop("env")
    b = trees.filter(F.col("env") == right).drop("env")
    return configs.diff(a, b).orderBy("path")
