"""Benchmark decontamination by BM25 with block-max WAND.

Test items are indexed: a posting holds an item and the BM25 impact of a term in it, divided by the
sum of the item's impacts, so that a passage with all of an item's terms scores 1 whatever its
length. Items stand in blocks of ``BLOCK``, and the index knows the largest impact of each term in
each block. Every training text is cut into passages that overlap by half and are twice as long as
the longest item, so that each copy of an item lies whole in one of them. Each passage is a query:
blocks whose largest impacts cannot reach the threshold are left out, the rest is searched item by
item with the WAND pivot. All items at or above the threshold are then verified by 5-word windows
of the passage: they must cover question and answer each, or the whole item. An answer of fewer
than five words is also there if its words stand beside the question.

Words are runs of letters and digits, lower-cased. Items are indexed in shards of bounded size with
statistics of their own, one pass over the texts for each shard.

Cases: null and empty texts and items match nothing; an item of fewer than five words is one window;
an item without an answer is judged by its question; equal items are found each; repeated rows give
equal rows; a very long text is scored in blocks of passages; with no items or no documents the
result is empty; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
BLOCK = 4
#: Score from which an item is retrieved, and share of windows of question and answer, or of both together, that must be there.
THRESHOLD, OVERLAP = 0.7, 0.8
WINDOW = 5
#: Words of items in one shard of the index.
SHARD_WORDS = 200_000
#: Passages scored at once.
PASSAGES = 256

_WORD = re.compile(r"[^\W_]+")
_FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long, last_word long"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def windows(words: list[str]) -> set[tuple[str, ...]]:
    n = min(WINDOW, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


class Index:
    """A shard of items: (item_id, words of the question, words of the answer)."""

    def __init__(self, items: list[tuple[int, list[str], list[str]]]):
        items = sorted(items, key=lambda x: (len(x[1]) + len(x[2]), x[0]))
        holding = Counter(t for _, q, a in items for t in {*q, *a})
        total, mean = len(items), sum(len(q) + len(a) for _, q, a in items) / len(items)
        self.items = items
        self.longest = max(len(q) + len(a) for _, q, a in items)
        self.parts = [(windows(q), windows(a)) for _, q, a in items]
        self.wholes = [windows(q + a) for _, q, a in items]
        self.terms: dict[str, int] = {}
        self.postings: list[list[tuple[int, float]]] = []  # of a term: (item, impact), items ascending
        for k, (_, q, a) in enumerate(items):
            impacts = {}
            for t, n in Counter(q + a).items():
                idf = math.log(1 + (total - holding[t] + 0.5) / (holding[t] + 0.5))
                impacts[t] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * (len(q) + len(a)) / mean))
            whole = sum(impacts.values())
            for t, v in impacts.items():
                at = self.terms.setdefault(t, len(self.terms))
                if at == len(self.postings):
                    self.postings.append([])
                self.postings[at].append((k, v / whole))
        self.blocks = -(-len(items) // BLOCK)
        #: the largest impact of each term in each block
        self.most = np.zeros((len(self.postings), self.blocks), np.float32)
        for t, row in enumerate(self.postings):
            for k, v in row:
                self.most[t, k // BLOCK] = max(self.most[t, k // BLOCK], v)
        self.in_block = [{} for _ in self.postings]
        for t, row in enumerate(self.postings):
            for k, v in row:
                self.in_block[t].setdefault(k // BLOCK, []).append((k, v))

    def search(self, terms: np.ndarray, block: int, threshold: float) -> Iterator[tuple[int, float]]:
        """Items of a block at or above the threshold, by moving cursors to the WAND pivot."""
        lists = [(row, float(self.most[t, block])) for t in terms.tolist() if (row := self.in_block[t].get(block))]
        cursors = [[row[0][0], 0, row, most] for row, most in lists]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for c in cursors:
                bound += c[3]
                if bound >= threshold - 1e-6:
                    pivot = c[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                score = 0.0
                for c in cursors:
                    if c[0] == pivot:
                        score += c[2][c[1]][1]
                if score >= threshold - 1e-9:
                    yield pivot, score
                pivot += 1
            for c in cursors:  # to the pivot, or past it once it is scored
                while c[0] < pivot:
                    c[1] += 1
                    c[0] = c[2][c[1]][0] if c[1] < len(c[2]) else math.inf
            cursors = [c for c in cursors if c[0] != math.inf]

    def _live(self, ids: np.ndarray) -> np.ndarray | None:
        """The blocks that a text with these terms can reach at all."""
        used = np.unique(ids[ids >= 0])
        if not len(used):
            return None
        live = np.flatnonzero(self.most[used].sum(axis=0) >= self._floor)
        return live if len(live) else None

    def retrieve(self, words: list[str], threshold: float) -> Iterator[tuple[int, int, float]]:
        """(passage, item, score) of each passage and item at or above the threshold."""
        self._floor = threshold - 1e-4  # sums of 32-bit numbers
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        live = self._live(ids)  # no passage scores above its text
        if live is None:
            return
        most = self.most[:, live]
        step = self.longest
        halves = -(-len(ids) // step)
        for start in range(0, max(1, halves - 1), PASSAGES):
            stop = min(start + PASSAGES, max(1, halves - 1))
            part = ids[start * step : (stop + 1) * step]
            at = np.flatnonzero(part >= 0)
            half = at // step
            n = stop - start
            # a passage is a half and the next one
            owner = np.concatenate([half, half - 1])
            term = np.concatenate([part[at], part[at]])
            ok = (owner >= 0) & (owner < n)
            key = np.unique(owner[ok] * len(self.postings) + term[ok])
            if not len(key):
                continue
            owner, term = key // len(self.postings), key % len(self.postings)
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            sums = np.add.reduceat(most[term], begins, axis=0)
            for r, c in zip(*np.nonzero(sums >= self._floor), strict=True):
                end = begins[r + 1] if r + 1 < len(begins) else len(term)
                for item, score in self.search(term[begins[r] : end], int(live[c]), threshold):
                    yield start + int(owner[begins[r]]), item, score

    def verified(self, words: list[str], threshold: float, overlap: float) -> list[tuple]:
        """(item_id, score, question and answer overlap, first and last word) of items that a text holds."""
        best: dict[int, tuple] = {}
        step = self.longest
        for passage, item, score in self.retrieve(words, threshold):
            first, last = passage * step, min((passage + 2) * step, len(words))
            near = words[first:last]
            there = windows(near) if len(near) >= WINDOW else set()
            question, answer = (_share(part, near, there) for part in self.parts[item])
            if answer is not None and answer < overlap and len(self.items[item][2]) < WINDOW:
                answer = max(answer, _beside(near, self.parts[item][0], self.items[item][2]))
            both = all(s is None or s >= overlap - 1e-9 for s in (question, answer))
            if (both or _share(self.wholes[item], near, there) >= overlap - 1e-9) and (item not in best or score > best[item][0]):
                best[item] = (score, *(1.0 if s is None else s for s in (question, answer)), first, last - 1)
        return [(self.items[k][0], *best[k]) for k in sorted(best, key=lambda k: self.items[k][0])]


def _share(part: set[tuple[str, ...]], words: list[str], there: set[tuple[str, ...]]) -> float | None:
    """The share of the windows of a part of an item that the words hold; of no windows, none."""
    short = {w for w in part if len(w) < WINDOW}
    return (len(part & there) + sum(_holds(words, w) for w in short)) / len(part) if part else None


def _beside(words: list[str], question: set[tuple[str, ...]], answer: list[str]) -> float:
    """The share of the answer's words that stand within a window and its length of the question, not in it."""
    taken, reach = np.zeros(len(words), bool), np.zeros(len(words), bool)
    for n in {len(w) for w in question}:
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in question:
                taken[k : k + n] = True
                reach[max(0, k - WINDOW - len(answer)) : k + n + WINDOW + len(answer)] = True
    left = Counter(words[k] for k in np.flatnonzero(reach & ~taken))
    return (left & Counter(answer)).total() / len(answer)


def _holds(words: list[str], run: tuple[str, ...]) -> bool:
    n = len(run)
    return any(tuple(words[k : k + n]) == run for k in range(len(words) - n + 1))


def _shards(items: DataFrame, question: str, answer: str | None, item_id: str) -> list[DataFrame]:
    """Items in parts of bounded size, each to be collected on its own."""
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(question).alias("question"),
                        (F.col(answer) if answer else F.lit("")).alias("answer"))
    size = sum(F.length(F.coalesce(F.col(c), F.lit(""))) for c in ("question", "answer"))
    n = max(1, math.ceil((rows.agg(F.sum(size)).first()[0] or 0) / (5 * SHARD_WORDS)))
    return [rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) for k in range(n)]


def _collected(part: DataFrame) -> list[tuple[int, list[str], list[str]]]:
    rows = [(r["item_id"], words_of(r["question"]), words_of(r["answer"])) for r in part.collect()]
    return [r for r in rows if r[1] or r[2]]


def find(docs: DataFrame, items: DataFrame, question: str = "question", answer: str | None = "answer",
         doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word, last_word) of what documents hold."""
    spark = docs.sparkSession
    shards = _shards(items, question, answer, item_id)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for part in shards:
        own = _collected(part)
        if not own:
            continue
        shared = spark.sparkContext.broadcast(Index(own))
        found = rows.mapInArrow(_finder(shared, threshold, overlap), _FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], _FOUND)


def _finder(shared, threshold: float, overlap: float):
    names = [f.split()[0] for f in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches):
        index = shared.value
        for b in batches:
            rows = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                rows += [(i, *r) for r in index.verified(words_of(t), threshold, overlap)]
            if rows:
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=names)

    return run


def with_answers(items: DataFrame, text: str = "text") -> DataFrame:
    """Add ``question`` and ``answer`` to items of one text: the answer is its last sentence, if it has more."""
    whole = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+$", "")
    two = r"(?s)^(.*[.!?\n])\s*(\S.*)$"
    question, answer = F.regexp_extract(whole, two, 1), F.regexp_extract(whole, two, 2)
    return items.withColumns({"question": F.when(question == "", whole).otherwise(question), "answer": answer})
