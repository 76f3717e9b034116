"""Merkle manifest of a dataset: a hash tree for each group of rows, and one over the trees' roots.

A leaf is the digest of a row. The leaves of a tree ascend by a key; every three consecutive nodes
have a parent, the digest of their digests, until one node is left. Nodes carry the interval
[lo, hi) of the leaf ranks they cover, so that nesting of intervals is ancestry.

* Ranks come from a range-partitioned sort and the row counts of its partitions: a large tree is
  ranked and built by many tasks.
* Levels are handled in bands of ``BAND``. A block of 3 ** ``BAND`` consecutive nodes is one row that
  holds the nodes of its levels; the block's own digest is a node of the next band. A band has a
  243rd of the rows of the one below.
* Ancestors are attached from the top down: the nodes of a band are joined with the blocks below
  by tree and bucket of the level (``lo`` over the width of a block), where the node's interval
  contains the block's. Of a leaf's parent interval, what is left after the leaf's own interval is
  the siblings, those before and those after.

Digests are SHA-256 of text in lowercase hex. Cases: nulls of a leaf's columns have their own mark;
null trees come first, and null keys first in their tree; equal keys are ordered by digest, and rows
that are equal in both have the same results; a lone leaf is its tree's root and has no siblings; an
empty table has no rows and no root; a text of any length is hashed in its row; columns other than those
named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.operators.ranks import with_ranks
from skyops.session import cut_lineage

FANOUT, BAND = 3, 5
BLOCK = FANOUT**BAND
_PATH = "array<struct<before:string,after:string>>"


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that values can't run into one another; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return digest(*map(field, columns))


def _parents(level: str) -> Column:
    """The nodes above those of an array column."""
    def node(i):
        kids = F.slice(level, i * FANOUT + 1, F.lit(FANOUT))
        return F.struct(F.element_at(kids, 1)["lo"].alias("lo"), F.element_at(kids, -1)["hi"].alias("hi"),
                        digest(F.array_join(F.transform(kids, lambda k: k["digest"]), "")).alias("digest"))

    count = F.ceil(F.size(level) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), node)


def _levels_left(n: Column) -> Column:
    """Levels of a band above ``n`` nodes: until one is left, at most ``BAND``."""
    out = F.lit(BAND)
    for k in reversed(range(BAND)):
        out = F.when(n <= FANOUT**k, k).otherwise(out)
    return out


def blocks(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row for each block of consecutive nodes (tree, n, rank, lo, hi, digest): its levels and its own digest.

    ``items`` are the nodes with their ``payload``; ``level0`` .. the nodes of each level as intervals.
    """
    item = F.struct("rank", "lo", "hi", "digest", *payload)
    rows = nodes.groupBy("tree", "n", F.floor(F.col("rank") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))  # BLOCK rows at most
    rows = rows.withColumn("levels", _levels_left(F.col("n")))
    rows = rows.withColumn("level0", F.transform("items", lambda x: F.struct(x["lo"], x["hi"], x["digest"])))
    top = F.col("level0")[0]
    for k in range(BAND):
        rows = rows.withColumn(f"level{k + 1}", F.when(F.col("levels") > k, _parents(f"level{k}")))
        top = F.coalesce(F.col(f"level{k + 1}")[0], top)
    return rows.withColumn("top", top).select(
        "tree", "n", "block", "items", "levels", *[f"level{k}" for k in range(BAND)], "top.*")


def _siblings(at: Column, k: int) -> Column:
    """Digests of the nodes in the parent's interval less the own one, before and after it."""
    rank = at["lo"]
    width = F.col("unit") * FANOUT ** (k + 1)
    inside = F.slice(f"level{k}", ((rank - F.col("lo")) / width).cast("int") * FANOUT + 1, F.lit(FANOUT))

    def joined(kept):
        return F.array_join(F.transform(F.filter(inside, kept), lambda x: x["digest"]), "")

    return F.when(F.col("levels") > k, F.struct(joined(lambda x: x["hi"] <= rank).alias("before"),
                                                joined(lambda x: x["lo"] > rank).alias("after")))


@dataclass(frozen=True)
class Trees:
    """The bands of a set of trees from the leaves up; ``roots``: tree, digest."""

    bands: list[DataFrame]
    payload: tuple[str, ...]

    @property
    def roots(self) -> DataFrame:
        tops = [b.where(F.col("n") <= BLOCK).select("tree", "digest") for b in self.bands]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out

    @property
    def nodes(self) -> DataFrame:
        """Every node: tree, level, lo, hi, digest."""
        out = None
        for b, band in enumerate(self.bands):
            def labelled(k, b=b):
                return F.transform(f"level{k}", lambda x: F.struct(
                    F.lit(b * BAND + k).alias("level"), x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))

            inner = [labelled(k) for k in range(BAND)]
            # a lone node is its own top; else the levels below the top are in the block, and the top is an item above or a root
            levels = F.slice(F.array(*inner), 1, F.greatest("levels", F.lit(0)))
            own = F.array(F.struct((F.col("levels") + b * BAND).alias("level"), "lo", "hi", "digest"))
            every = F.concat(F.flatten(levels), F.when(F.col("n") <= BLOCK, own).otherwise(F.array().cast(
                "array<struct<level:int,lo:bigint,hi:bigint,digest:string>>")))
            rows = band.select("tree", F.inline(every))
            out = rows if out is None else out.unionByName(rows)
        return out

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """Each leaf's tree, rank, digest and payload, ``path`` (siblings upward), ``subroot`` and ``root``.

        ``above`` gives tree, root and path of the roots; without it each tree's root is the last.
        """
        found = None
        for b in reversed(range(len(self.bands))):
            band = self.bands[b].withColumn("unit", F.lit(BLOCK**b))
            heads = band.where(F.col("n") <= BLOCK).withColumn("subroot", F.col("digest"))
            if above is None:
                heads = heads.withColumns({"root": F.col("digest"), "path": F.array().cast(_PATH)})
            else:
                heads = _beside(heads, above.select(F.col("tree").alias("_tree"), "root", "path"), F.lit(True)).drop("_tree")
            if found is not None:
                width = BLOCK ** (b + 1)
                higher = found.select(F.col("tree").alias("_tree"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                      "subroot", "root", "path")
                inside = ((F.floor(F.col("lo") / width) == F.floor(F.col("_lo") / width))
                          & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
                rest = _beside(band.where(F.col("n") > BLOCK), higher, inside).drop("_tree", "_lo", "_hi")
                heads = heads.unionByName(rest)
            own = F.transform("items", lambda x: F.struct(
                x.alias("item"), F.array_compact(F.array(*[_siblings(x, k) for k in range(BAND)])).alias("own")))
            found = heads.select("tree", "subroot", "root", "path", F.inline(own)).select(
                "tree", "item.*", "subroot", "root", F.concat("own", "path").alias("path"))
        return found


def _beside(rows: DataFrame, others: DataFrame, condition: Column) -> DataFrame:
    return rows.join(others, F.col("tree").eqNullSafe(F.col("_tree")) & condition)


def build(rows: DataFrame, payload: Sequence[str] = ()) -> Trees:
    """The trees over ranked leaves: tree, rank, n, digest, payload."""
    nodes = rows.select("tree", "n", "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *payload)
    most = nodes.agg(F.max("n")).first()[0] or 0
    bands, own = [], list(payload)
    while not bands or most > 1:
        band = cut_lineage(blocks(nodes, own))
        bands.append(band)
        nodes = band.where(F.col("n") > BLOCK).select(
            "tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "lo", "hi", "digest")
        most, own = -(-most // BLOCK), []
    return Trees(bands, tuple(payload))


def manifest(df: DataFrame, tree: str, order: str, columns: Sequence[str],
             payload: dict[str, Column] | None = None) -> tuple[Trees, Trees]:
    """The trees of the rows by ``tree``, and the tree over their roots; ``payload`` stays with the leaves."""
    payload = payload or {}
    names = list(payload)
    leaves = df.select(F.col(tree).alias("tree"), F.col(order).alias("_order"),
                       leaf([F.col(c) for c in columns]).alias("digest"), *[c.alias(n) for n, c in payload.items()])
    # stored first, since a range-partitioned sort reads its input twice and the texts are hashed in it
    lower = build(with_ranks(cut_lineage(leaves), ["tree"], ["_order", "digest"]), names)
    roots = lower.roots.select(F.lit(0).alias("tree"), F.col("tree").alias("group"), "digest")
    return lower, build(with_ranks(roots, ["tree"], ["group"]), ["group"])


def proofs(lower: Trees, upper: Trees) -> DataFrame:
    """tree, rank, digest, payload, subroot, root and the whole ``path`` of every leaf."""
    tops = upper.paths().select(F.col("group").alias("tree"), "root", "path")
    return lower.paths(tops).drop("lo", "hi")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings from the leaf to the root, left to right in each level."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, s: digest(s["before"], acc, s["after"]))
