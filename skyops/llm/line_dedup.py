"""Fuzzy line deduplication over the whole corpus.

Lines are compared trimmed and lower-cased, by their sets of 7-character shingles. MinHash
signatures are cut into bands (9 of 4 rows: lines of similarity 0.8 share one with probability
0.991, of 0.9 with 0.9998); lines that share a band are compared exactly (``groups``), links of
similarity 0.8 or more go to components by distributed star rounds, and of each component only the
first line by (doc_id, line_no) is kept.

Cases: null text has no lines; blank lines are kept and have no component; a line of fewer than
seven characters is one shingle, so it matches only equal lines; equal lines are one component;
equal rows are taken as one document and keep the same lines, rows with different texts under one id
as documents of their own; a null id comes before all others, and each row with one is a document; a
document whose lines with text all repeat earlier ones is dropped by ``without_repeats``,
one without any line of text is kept as it is; other columns stay; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.llm import groups
from skyops.llm.batches import slices
from skyops.llm.components import components
from skyops.llm.words import distinct, mix
from skyops.session import cut_at, cut_lineage, remove

SIMILARITY = 0.8
SHINGLE = 7
BANDS, ROWS = 9, 4
#: Characters in a part of a group.
PART = 400_000
#: Lines that a task remembers so as not to sign them again.
REMEMBERED = 200_000

_RNG = np.random.default_rng(20240502)
_PLACE = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_TIMES = _RNG.integers(1, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_BAND = _RNG.integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines in order, and where each line's begin."""
    padded = [s if len(s) >= SHINGLE else s.ljust(SHINGLE, "\0") for s in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(s) for s in padded])
    n = len(points) - SHINGLE + 1
    out = points[:n] * _PLACE[0]
    for k in range(1, SHINGLE):
        out += points[k : k + n] * _PLACE[k]
    inside = np.ones(len(points), bool)
    ends = np.cumsum(length)
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    counts = length - SHINGLE + 1
    return mix(out[inside[:n]]), np.cumsum(counts) - counts


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    hashed, starts = shingles(lines)
    return [distinct(part) for part in np.split(hashed, starts[1:])]


def bands(lines: list[str]) -> np.ndarray:
    """The band keys of each line, as rows of 64-bit numbers."""
    hashed, starts = shingles(lines)
    low = hashed.astype(np.uint32)
    out = np.zeros((len(lines), BANDS), np.uint64)
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat(low * _TIMES[k] + _PLUS[k], starts)
        out[:, k // ROWS] += least.astype(np.uint64) * _BAND[k % ROWS]
    return mix(out + np.arange(BANDS, dtype=np.uint64))


def with_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``_row``, which tells documents under one id apart: a hash of the text, or a number without an id."""
    named = docs.where(F.col(doc_id).isNotNull()).withColumn("_row", F.xxhash64(text))
    unnamed = docs.where(F.col(doc_id).isNull()).withColumn("_row", F.monotonically_increasing_id())
    return named.unionByName(cut_lineage(unnamed))


def lines_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, _row, line_no, id, line): ``id`` is a 64-bit hash of the trimmed, lower-cased line; null if blank."""
    lines = docs.select(F.col(doc_id).alias("doc_id"), "_row", F.posexplode(F.split(text, "\n")).alias("line_no", "raw"))
    line = F.lower(F.btrim("raw", F.lit(" \t\n\v\f\r")))
    lines = lines.select("doc_id", "_row", F.col("line_no").cast("long").alias("line_no"), line.alias("line"))
    return lines.withColumn("id", F.when(F.col("line") != "", F.xxhash64("line")))


def _signed(lines: DataFrame) -> DataFrame:
    """doc_id, _row, line_no and id of every line; line, weight and keys where a task first meets the id."""
    kind = lines.schema["doc_id"].dataType

    def run(batches):
        seen: set[int] = set()
        for b in (x.slice(start, end - start) for x in batches for start, end in slices(x.column("line"))):
            lines = []
            for i, t in zip(b.column("id").to_pylist(), b.column("line").to_pylist(), strict=True):
                new = i is not None and i not in seen
                lines.append(t if new else None)
                if new:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(i)
            yield of(b, lines)

    def of(b, lines):
        fresh = np.array([t is not None for t in lines], bool)
        texts = [t for t in lines if t is not None]
        keys = bands(texts).view(np.int64) if texts else np.zeros((0, BANDS), np.int64)
        offsets = np.concatenate([[0], np.cumsum(fresh * BANDS)]).astype(np.int32)
        size = np.zeros(len(fresh), np.int64)
        size[fresh] = [len(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc_id", "_row", "line_no", "id")),
             pa.array(lines, pa.string()), pa.array(size, mask=~fresh), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()), mask=pa.array(~fresh))],
            names=["doc_id", "_row", "line_no", "id", "line", "weight", "keys"])

    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("_row", "line_no", "id")),
                           T.StructField("line", T.StringType()), T.StructField("weight", T.LongType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])
    return lines.select("doc_id", "_row", "line_no", "id", "line").mapInArrow(run, schema)


def line_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, component, kept) of every line of the corpus."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _line_rows(with_rows(own, "doc_id", "text"), "doc_id", "text").drop("_row")


def _line_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``line_components`` of documents ``with_rows``, and ``_row``."""
    signed, signed_at = cut_at(_signed(lines_of(docs, doc_id, text)))
    fresh = signed.where("keys is not null")
    pairs, pairs_at = cut_at(groups.pairs_with_leader(fresh.select("id", F.explode("keys").alias("key"))))
    wanted, wanted_at = cut_at(pairs.select("id").distinct())
    texts = groups.possible(fresh.select("id", "line", "weight"), wanted, "id").join(wanted, "id")
    texts, texts_at = cut_at(texts.groupBy("id").agg(F.first("line").alias("text"), F.max("weight").alias("weight")))
    links = groups.links(groups.in_parts(pairs, texts.select("id", "weight"), PART), texts.select("id", "text"), shingle_sets, SIMILARITY)
    linked = components(cut_lineage(links))
    numbered = signed.select("doc_id", "_row", "line_no", "id").join(linked, "id", "left").select(
        "doc_id", "_row", "line_no", F.coalesce("component", "id").alias("component"))
    numbered = cut_lineage(numbered)
    remove(docs.sparkSession, signed_at, pairs_at, wanted_at, texts_at)  # all lines and their keys among them
    in_row = numbered.where("component is not null").groupBy("component", "doc_id", "_row").agg(F.min("line_no").alias("line_no"))
    in_id = in_row.groupBy("component", "doc_id").agg(F.min_by("line_no", "_row").alias("line_no"), F.min("_row").alias("_row"))
    # a null id comes first: it is the least of a component that has one
    none = F.col("doc_id").isNull()
    first = in_id.groupBy("component").agg(
        F.min("doc_id").alias("low"), F.max(none).alias("none"),
        *(F.min_by(c, "doc_id").alias(f"low{c}") for c in ("_row", "line_no")),
        *(F.min(F.when(none, F.col(c))).alias(f"none{c}") for c in ("_row", "line_no")))
    first = first.select(F.col("component").alias("_component"), F.when(~F.col("none"), F.col("low")).alias("_doc"),
                         *(F.when(F.col("none"), F.col(f"none{c}")).otherwise(F.col(f"low{c}")).alias(f"_first{c}")
                           for c in ("_row", "line_no")))
    at = ((numbered["component"] == first["_component"]) & numbered["doc_id"].eqNullSafe(first["_doc"])
          & (numbered["_row"] == first["_first_row"]) & (numbered["line_no"] == first["_firstline_no"]))
    return numbered.join(first, at, "left").select(
        "doc_id", "_row", "line_no", "component", (F.col("component").isNull() | F.col("_component").isNotNull()).alias("kept"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept lines of each text, less documents of which no line of text is kept."""
    # the columns of ``docs`` travel as one, so that no name clashes
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct(*map(_quoted, docs.columns)).alias("_all"))
    rows = with_rows(whole, "doc_id", "text")
    own = _line_rows(rows, "doc_id", "text").groupBy(F.col("doc_id").alias("_doc"), F.col("_row").alias("_own")).agg(
        F.array_sort(F.collect_set(F.struct("line_no", "kept"))).alias("_lines"),
        F.max(F.col("component").isNotNull()).alias("_any"),
        F.max(F.col("kept") & F.col("component").isNotNull()).alias("_left"))
    joined = rows.join(own, rows["doc_id"].eqNullSafe(own["_doc"]) & (rows["_row"] == own["_own"]), "left")
    joined = joined.where(F.coalesce(~F.col("_any") | F.col("_left"), F.lit(True)))
    both = F.filter(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("_lines.kept").alias("kept")), lambda x: x["kept"])
    rebuilt = F.array_join(F.transform(both, lambda x: x["line"]), "\n")
    value = F.when(F.col("_lines").isNull(), F.col("text")).otherwise(rebuilt)
    return joined.select(*[(value if c == text else F.col("_all").getField(c)).alias(c) for c in docs.columns])


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
