"""Similarity join on word 5-grams by signature trees.

1. Documents with equal sets of 5-grams form one class; only classes are compared.
2. Prefix filter: two sets of similarity s share one of their first n - ceil(s n) + 1 elements, in
   any order common to all. 5-grams that a sample shows to be frequent come last, so that a common
   passage seldom groups documents; the sample decides speed only, never results.
3. In each group a signature tree is joined with itself. A leaf holds the bitmap of a set, a node
   the OR of its children's, with the range of their sizes; a pair of nodes is left out when the
   bits they share allow too small an overlap. A class without a possible partner leaves here.
4. The trees of the rest are joined again, now over whole texts, and pairs of leaves are verified.
   Pairs already connected are skipped.
5. Links go to components by star rounds (``components``).

Cases: null or blank text has an empty set and is linked with nothing; fewer than five words are
one 5-gram; rows with a null id get their count, but take part in no link and have no component;
repeated rows are one class and each gives a row; rows that share an id but not a text give a row
each, and since the id is one, what is linked with any of them is connected; ids are taken as whole
numbers, and one that is none counts as null; ties do not matter, since components do not depend on order; other columns of the input are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm import groups
from skyops.llm.components import components
from skyops.llm.words import mix, shingle_set, shingle_sets
from skyops.session import cut_at, cut_lineage, remove

SIMILARITY = 0.8
FANOUT = 8
#: 5-grams in a part of a group.
PART = 1_000_000
#: Documents of which frequent 5-grams are taken, how often one must occur there, and how many are told to the tasks.
SAMPLE_DOCS, SAMPLE_COUNT, MOST_FREQUENT = 20_000, 3, 200_000
_LEAST_BITS = 64

_SETS = "id long, hash long, n_shingles long, class long, prefix array<long>, bits binary"


def bitmap(elements: np.ndarray) -> np.ndarray:
    """The elements hashed into a bitmap of the power of two above twice their number, as 64-bit words."""
    width = max(_LEAST_BITS, 1 << (2 * max(1, len(elements)) - 1).bit_length())
    at = mix(elements) & np.uint64(width - 1)
    flags = np.zeros(width, bool)
    flags[at] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


class SignatureTree:
    """Levels of nodes over bitmaps of one width, leaves first; items in ascending order of size."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        surplus = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)  # elements beyond the bits set
        self.levels = [(bits, sizes, sizes, surplus)]
        while len(self.levels[-1][0]) > 1:
            b, low, high, over = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(over, at)))

    def children(self, level: int, node: int) -> slice:
        return slice(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))

    def leaves(self, level: int, node: int) -> slice:
        width = FANOUT**level
        return slice(node * width, min((node + 1) * width, len(self.levels[0][0])))


def _possible(a: tuple, x: slice, b: tuple, y: slice, similarity: float) -> np.ndarray:
    """Which nodes ``x`` of level ``a`` and ``y`` of ``b`` may hold a link, by their largest possible overlap."""
    shared = np.bitwise_count(a[0][x][:, None] & b[0][y][None]).sum(axis=2, dtype=np.int64)
    most = np.minimum(shared + np.minimum(a[3][x][:, None], b[3][y][None]),
                      np.minimum(a[2][x][:, None], b[2][y][None]))
    least = (a[1][x][:, None] + b[1][y][None]) * (similarity / (1 + similarity))
    return (most >= least - 1e-6) & (most >= similarity * np.maximum(a[1][x][:, None], b[1][y][None]) - 1e-6)


def dual(one: SignatureTree, two: SignatureTree, done, visit, similarity: float = SIMILARITY) -> None:
    """Call ``visit(i, j)`` for pairs of leaves that may be linked, but for spans that are ``done``."""
    same, tops = one is two, (len(one.levels) - 1, len(two.levels) - 1)
    stack = [(tops[0], 0, tops[1], 0)]
    while stack:
        p, i, q, j = stack.pop()
        if done(one.leaves(p, i), two.leaves(q, j)):
            continue
        if p == q == 0:
            if not (same and i == j):
                visit(i, j)
            continue
        p, x = (p - 1, one.children(p, i)) if p else (p, slice(i, i + 1))
        q, y = (q - 1, two.children(q, j)) if q else (q, slice(j, j + 1))
        for u, v in zip(*np.nonzero(_possible(one.levels[p], x, two.levels[q], y, similarity))):
            if not (same and x.start + u > y.start + v):
                stack.append((p, x.start + int(u), q, y.start + int(v)))


def _folded(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] | bits[:, half:]


def tree_join(bits: list[np.ndarray], sizes: np.ndarray, done, visit, similarity: float = SIMILARITY) -> None:
    """Join bitmaps with themselves, by trees of one width each and of neighbouring widths.

    ``sizes`` ascend, so items of one width are together. A link between two widths is only possible
    between neighbours, since the larger set has at most 1.25 times the elements of the smaller.
    """
    widths = np.array([len(b) for b in bits])
    spans = [(w, np.flatnonzero(widths == w)) for w in np.unique(widths)]
    last = None
    for w, at in spans:
        start, here = int(at[0]), np.stack([bits[k] for k in at])
        tree = SignatureTree(here, sizes[at])
        _joined(tree, start, tree, start, done, visit, similarity)
        if last and 2 * last[0] == w:
            folded = SignatureTree(_folded(here), sizes[at])
            _joined(last[1], last[2], folded, start, done, visit, similarity)
        last = (w, tree, start)


def _joined(one, a, two, b, done, visit, similarity) -> None:
    dual(one, two, lambda x, y: done(slice(x.start + a, x.stop + a), slice(y.start + b, y.stop + b)),
         lambda i, j: visit(i + a, j + b), similarity)


def search(similarity: float) -> groups.Search:
    """The search of a part by signature trees."""
    def run(sets, found, linked):
        def visit(i, j):
            if linked(i, j):
                found.link(i, j)

        kept = [k for k, s in enumerate(sets) if len(s)]
        first = kept[0] if kept else 0  # empty sets are smallest, so they come first
        tree_join([bitmap(sets[k]) for k in kept], np.array([len(sets[k]) for k in kept]),
                  lambda x, y: found.one(slice(x.start + first, x.stop + first), slice(y.start + first, y.stop + first)),
                  lambda i, j: visit(i + first, j + first), similarity)

    return run


def _frequent(docs: DataFrame) -> np.ndarray:
    """Sorted 5-grams that many documents of a sample share; at most ``MOST_FREQUENT``."""
    every = max(1, math.ceil(docs.count() / SAMPLE_DOCS))
    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)

    def grams(batches):
        for b in batches:
            for t in b.column("text").to_pylist():
                yield pa.record_batch([pa.array(shingle_set(t).view(np.int64))], names=["gram"])

    counted = sample.mapInArrow(grams, "gram long").groupBy("gram").count().where(F.col("count") >= SAMPLE_COUNT)
    top = counted.orderBy(F.desc("count"), "gram").limit(MOST_FREQUENT).select("gram").toPandas()
    return np.sort(top["gram"].to_numpy(np.int64).view(np.uint64))


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


def set_class(elements: np.ndarray) -> int:
    """A 64-bit number for a set; sets are taken as equal if theirs are."""
    mixed = mix(elements + np.uint64(len(elements)))
    total, parity = mixed.sum(keepdims=True), np.bitwise_xor.reduce(mixed, initial=np.uint64(0), keepdims=True)
    return int((mix(total) + parity).view(np.int64)[0])


def shingle_rows(docs: DataFrame, similarity: float) -> DataFrame:
    """Set size, class, prefix and bitmap of each document (id, hash, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs))

    def run(batches):
        common = shared.value
        for b in batches:
            rows = []
            for i, h, t in zip(*(b.column(c).to_pylist() for c in ("id", "hash", "text")), strict=True):
                s = shingle_set(t)
                n = len(s)
                late = _is_in(s, common)
                first = np.concatenate([s[~late], s[late]])[: n - math.ceil(similarity * n - 1e-9) + 1]
                rows.append((i, h, n, set_class(s), first.view(np.int64), bitmap(s).tobytes() if n else None))
                if len(rows) == 1000:
                    yield _set_batch(rows)
                    rows = []
            if rows:
                yield _set_batch(rows)

    return docs.mapInArrow(run, _SETS)


def _set_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                           names=["id", "hash", "n_shingles", "class", "prefix", "bits"])


def _with_partner(members: DataFrame, similarity: float) -> DataFrame:
    """The (leader, id) of groups of one part that the bitmaps leave a partner, and all of larger groups."""
    def run(key, table):
        ids = table["id"].to_pylist()
        size = table["n_shingles"].to_numpy()
        order = np.lexsort((np.array(ids), size))
        bits = [np.frombuffer(table["bits"][int(k)].as_py(), np.uint64) for k in order]
        kept = np.zeros(len(ids), bool)

        def done(x, y):
            return bool(kept[x].all() and kept[y].all())

        def visit(i, j):
            kept[i] = kept[j] = True

        tree_join(bits, size[order], done, visit, similarity)
        out = [ids[int(k)] for k in order[kept]]
        return pa.table({"leader": pa.array([key[0].as_py()] * len(out), pa.int64()), "id": pa.array(out, pa.int64())})

    single = members.where("parts = 1").groupBy("leader").applyInArrow(run, "leader long, id long")
    return single.unionByName(members.where("parts > 1").select("leader", "id").distinct())


def _same_id(rows: DataFrame) -> DataFrame:
    """Links between the classes of an id that has several."""
    several = rows.groupBy("id").agg(F.min("class").alias("b"), F.max("class").alias("last")).where("b < last")
    return rows.join(several.select("id", "b"), "id").where("class > b").select(F.col("class").alias("a"), "b").distinct()


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(``doc_id``, n_shingles, component_id) of every row: the least id reachable by links, itself included."""
    docs = df.select(F.col(doc_id).try_cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text"))  # tells rows of one id apart
    sets, sets_at = cut_at(shingle_rows(docs, similarity))
    rows = cut_lineage(sets.select("id", "hash", "n_shingles", "class"))
    filled = rows.where("n_shingles > 0 and id is not null")
    classes = filled.groupBy("class").agg(F.min("id").alias("doc"), F.min_by("hash", "id").alias("hash"))
    # equal rows may share their id; by the columns of the join, so that they are not shuffled again
    kept = sets.withColumnRenamed("id", "doc").join(classes, ["class", "doc", "hash"]).dropDuplicates(["class", "doc", "hash"])
    kept, kept_at = cut_at(kept.select(F.col("class").alias("id"), "doc", "hash", "n_shingles", "prefix", "bits"))
    remove(df.sparkSession, sets_at)  # prefixes and bitmaps are the bulk of the working files
    names = cut_lineage(kept.select("id", "doc", "hash", "n_shingles"))
    keys = kept.select("id", F.explode("prefix").alias("key"))
    pairs, pairs_at = cut_at(groups.pairs_with_leader(keys))
    weights = names.select("id", F.col("n_shingles").alias("weight"))
    first = groups.in_parts(pairs, weights, PART).join(kept.select("id", "n_shingles", "bits"), "id")
    pairs = cut_lineage(_with_partner(first, similarity))
    remove(df.sparkSession, kept_at, pairs_at)
    row = F.xxhash64("doc", "hash").alias("row")
    wanted = cut_lineage(pairs.select("id").distinct().join(names, "id").select("id", "doc", "hash", row))
    own = groups.possible(docs.withColumnRenamed("id", "doc").select("doc", "hash", "text", row), wanted, "row")
    texts, texts_at = cut_at(own.join(wanted, ["row", "doc", "hash"]).select("id", "text"))
    links = groups.links(groups.in_parts(pairs, weights, PART), texts, shingle_sets, similarity, search(similarity))
    of_class = components(cut_lineage(links.unionByName(_same_id(filled.select("id", "class")))))
    remove(df.sparkSession, texts_at)
    found = classes.select("class", "doc").join(of_class.withColumnRenamed("id", "class"), "class", "left").select(
        "class", "doc", F.coalesce("component", "class").alias("component"))
    found = cut_lineage(found)
    least = found.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = found.join(least, "component").select("class", "component_id")
    linked = rows.where("n_shingles > 0").select("id", "n_shingles", "class").join(named, "class", "left").select(
        F.col("id").alias(doc_id), "n_shingles",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = rows.where("n_shingles = 0").select(F.col("id").alias(doc_id), "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone)
