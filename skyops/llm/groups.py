"""Links between similar items that share a key, without gathering all items of a key.

Items that share a key form groups named by the least item of the key, so that a cluster of near
copies, which shares hundreds of keys, is mostly one group. A group is dealt into parts of bounded
weight. Each part also holds the group's leader and is searched on its own; what is linked to the
leader in any part is connected. What is left is decided by the triangle inequality, which Jaccard
distances obey: an item that is open can only be linked with items whose distance to the leader
differs from its own by no more than the largest distance of a link. Those are compared across
parts, a pair of parts at a time. No link between items of a group is lost at any size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm.batches import slices
from skyops.session import cut_lineage

_FOUND = "leader long, part long, a long, b long, distance double, open boolean"
_SLACK = 1e-9


#: Words of 64 bits in a filter of keys: 4 MB, whatever the number of keys.
FILTER = 1 << 18


def possible(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Rows whose 64-bit ``column`` may be among those of ``wanted``: one hash bit for each, so that few others are shuffled.

    The bits are a table of at most ``FILTER`` rows, so its broadcast is bounded; when they fill up, more
    rows pass and nothing is lost. Join what passes with an inner join: Spark takes a semi join before the filter.
    """
    hashed = F.xxhash64(column)
    slot, bit = F.pmod(hashed, F.lit(FILTER)), F.pmod(F.shiftrightunsigned(hashed, 18), F.lit(64)).cast("int")
    bits = wanted.groupBy(slot.alias("_slot")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits"))
    mine = F.call_function("shiftright", F.col("_bits"), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return rows.withColumn("_slot", slot).join(F.broadcast(bits), "_slot").where(mine).select(*rows.columns)


def pairs_with_leader(keys: DataFrame) -> DataFrame:
    """(leader, id) for each (id, key) whose key two ids share; the leader is the least id of the key.

    The shared keys are written first, so that the shuffle of all keys is gone before the join, which few others enter.
    """
    shared = keys.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
    shared = cut_lineage(shared.where("leader < last").select("key", "leader"))
    return possible(keys, shared, "key").join(shared, "key").select("leader", "id").distinct()


def in_parts(pairs: DataFrame, weights: DataFrame, limit: int) -> DataFrame:
    """(leader, parts, part, id) with the leader in every part of its group; parts weigh about ``limit``."""
    rows = pairs.join(weights, "id")
    sizes = rows.groupBy("leader").agg(F.ceil(F.sum("weight") / limit).cast("long").alias("parts"))
    sizes = sizes.select("leader", F.greatest("parts", F.lit(1)).alias("parts"))
    others = rows.where("id != leader").join(sizes, "leader").select(
        "leader", "parts", F.pmod(F.xxhash64("id", "leader"), "parts").alias("part"), "id")
    leaders = sizes.select("leader", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.col("leader").alias("id"))
    return others.unionByName(leaders)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two sorted arrays of distinct values; two empty ones give 0."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0.0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int(np.count_nonzero(y[at] == x))
    return both / (len(x) + len(y) - both)


class Found:
    """The components among the items of one part."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, i: int, j: int) -> None:
        a, b = self.of[i], self.of[j]
        if a != b:
            self.of[self.of == max(a, b)] = min(a, b)

    def one(self, *spans: slice) -> bool:
        """Whether all items of the spans are in one component."""
        first = self.of[spans[0].start]
        return all((self.of[s] == first).all() for s in spans)


Search = Callable[[list[np.ndarray], Found, Callable[[int, int], bool]], None]


def every_pair(sets: list[np.ndarray], found: Found, linked: Callable[[int, int], bool]) -> None:
    """Compare items that are in different components yet, nearest sizes first."""
    n = len(sets)
    for step in range(1, n):
        for i in np.flatnonzero(found.of[: n - step] != found.of[step:]):
            if found.of[i] != found.of[i + step] and linked(i, i + step):
                found.link(i, i + step)


def _compare(ids: list[int], sets: list[np.ndarray], search: Search, similarity: float) -> tuple[list[int], Found]:
    order = sorted(range(len(ids)), key=lambda k: (len(sets[k]), ids[k]))
    ids, sets = [ids[k] for k in order], [sets[k] for k in order]
    found = Found(len(ids))

    def linked(i, j):
        small, large = sorted((len(sets[i]), len(sets[j])))
        return small >= similarity * large - _SLACK and jaccard(sets[i], sets[j]) >= similarity - _SLACK

    search(sets, found, linked)
    return ids, found


def by_key(rows: DataFrame, keys: list[str], values: list[str], fn: Callable, schema: str, batch: Callable,
           prepare: dict[str, Callable]) -> DataFrame:
    """``fn(key, {value: list})`` for the rows of each key, as ``batch(rows)`` of what it returns.

    The rows are dealt and sorted by key and stream through the tasks, so that a hundred thousand
    small groups cost no call each; a task holds one group at a time. ``prepare`` turns the values of
    a column into others, a bounded slice at once.
    """
    def run(batches):
        key, held, out = None, {v: [] for v in values}, []
        for b in (x.slice(start, end - start) for x in batches for start, end in slices(x.column("text"))):
            columns = [prepare[v](b.column(v).to_pylist()) if v in prepare else b.column(v).to_pylist() for v in values]
            for k, *row in zip(zip(*(b.column(k).to_pylist() for k in keys), strict=True), *columns, strict=True):
                if k != key:
                    if key is not None:
                        out += fn(key, held)
                    key, held = k, {v: [] for v in values}
                for v, x in zip(values, row, strict=True):
                    held[v].append(x)
            if out:
                yield batch(out)
                out = []
        if key is not None and (out := fn(key, held)):
            yield batch(out)

    dealt = rows.select(*keys, *values).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def _items(held: dict[str, list]) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}
    for i, elements in zip(held["id"], held["text"], strict=True):
        out.setdefault(i, elements)
    return out


def links(members: DataFrame, texts: DataFrame, to_sets: Callable, similarity: float,
          search: Search = every_pair) -> DataFrame:
    """(a, b) links that connect all items of ``members`` that are similar, by way of shared ones.

    ``members``: of ``in_parts``; ``texts`` (id, text): each id at least once, where any row of an id
    does; ``to_sets`` makes sorted sets of a list of texts. ``search`` calls ``linked(i, j)`` for the pairs of a part that may be similar.
    """
    def of_part(key, held):
        leader, parts, part = key
        sets = _items(held)
        ids, found = _compare(list(sets), list(sets.values()), search, similarity)
        low = {}
        for i, c in zip(ids, found.of.tolist(), strict=True):
            low[c] = min(i, low.get(c, i))
        rows = [(leader, part, i, low[c], None, None) for i, c in zip(ids, found.of.tolist(), strict=True) if i != low[c]]
        if parts > 1 and leader in sets:
            own = found.of[ids.index(leader)]
            rows += [(leader, part, i, None, 1 - jaccard(sets[i], sets[leader]), bool(c != own))
                     for i, c in zip(ids, found.of, strict=True) if i != leader]
        return rows

    rows = members.join(texts, "id")
    seen = cut_lineage(by_key(rows, ["leader", "parts", "part"], ["id", "text"], of_part, _FOUND, _batch, {"text": to_sets}))
    out = seen.where("b is not null").select("a", "b")
    far = seen.where("distance is not null").select("leader", "part", F.col("a").alias("id"), "distance", "open")
    if far.where("open").isEmpty():
        return out
    reach = 1 - similarity + _SLACK
    span = far.where("open").groupBy("leader").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    left = far.join(span, "leader").where(
        F.col("open") | F.col("distance").between(F.col("low") - reach, F.col("high") + reach))
    return out.unionByName(_across(cut_lineage(left), texts, to_sets, similarity, search))


def _across(left: DataFrame, texts: DataFrame, to_sets: Callable, similarity: float, search: Search) -> DataFrame:
    """Links between what is left of different parts of a group."""
    used = left.select("leader", "part").distinct()
    pairs = used.join(used.select("leader", F.col("part").alias("other")), "leader")
    blocks = pairs.select("leader", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))
    rows = left.join(blocks.where("x < y").distinct(), ["leader", "part"]).join(texts, "id")

    def of_block(key, held):
        sets = _items(held)
        ids, found = _compare(list(sets), list(sets.values()), search, similarity)
        low: dict[int, int] = {}
        return [(key[0], None, i, low[c], None, None) for i, c in zip(ids, found.of.tolist(), strict=True)
                if low.setdefault(c, i) != i]

    return by_key(rows, ["leader", "x", "y"], ["id", "text"], of_block, _FOUND, _batch, {"text": to_sets}).select("a", "b")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.float64(), pa.bool_()]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                           names=["leader", "part", "a", "b", "distance", "open"])
