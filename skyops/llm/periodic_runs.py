"""Runs of periodic words in texts, found by minimizers at several scales.

A run is a stretch of words with smallest period q, at least ``TIMES`` * q and ``LEAST`` words long,
that no neighbouring word extends. Periods below ``SHORTEST`` are scanned directly: words equal to
those a lag before. For a period q from s up to 2 s - 1, s a power of two, the windows of s
consecutive grams of 2 s words choose the grams of least hash. A run of four periods holds two such
windows q apart; they choose the same grams, and since a gram is longer than the period, equal grams
in the run lie a multiple of q apart: neighbours among equal chosen grams are seeds at distance q.
Seeds are extended both ways by hashes of spans, and each stretch is confirmed word by word. A
stretch that a shorter period explains is found with that period as well, and the shortest is kept.

The texts of a batch are laid one after another with a word of its own between them, and all steps
are array operations over the batch in linear time a scale; a scale reads only the texts that may
hold its periods.

Words are runs of characters other than space and \\t \\n \\v \\f \\r, compared exactly; hashes only
propose. Cases: null, empty and blank texts have no runs and collapse to the empty text; a very long
text is a slice of its own and is read whole; equal rows give equal results; runs may overlap, and
ties need no rule, since all runs are kept, by start, then period; an empty table gives no rows;
added columns replace columns of the same names and others stay.
"""

from __future__ import annotations

from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.words import Powers, mix

LEAST, TIMES = 6, 4
#: Periods below this are scanned directly; the first scale.
SHORTEST = 8

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_EMPTY = np.zeros((0, 3), np.int64)


class Numbering(dict):
    """A number for each distinct word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def lag_scan(words: np.ndarray, lag: int) -> np.ndarray:
    """(start, end, lag) of the longest stretches with words equal to those ``lag`` before."""
    edge = np.flatnonzero(np.diff(words[:-lag] == words[lag:], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2] + lag
    kept = ends - starts >= max(LEAST, TIMES * lag)
    return np.stack([starts[kept], ends[kept], np.full(kept.sum(), lag)], axis=1)


def _spread(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` over each run of ``size`` (a power of two) values, by doubling."""
    step = 1
    while step < size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


class Spans:
    """Hashes of spans of words: prefix sums of a polynomial modulo 2**64."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.up, self.down = Powers.of(self.n + 1)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mix(words.view(np.uint64)) * self.up[: self.n], out=self.total[1:])

    def grams(self, size: int) -> np.ndarray:
        return mix((self.total[size:] - self.total[:-size]) * self.down[: self.n - size + 1])

    def same(self, at: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words from ``at`` equal those ``lag`` later; False beyond the ends."""
        inside = (at >= 0) & (at + lag + size <= self.n)
        x = np.where(inside, at, 0)
        y = np.where(inside, at + lag, 0)
        z = np.where(inside, size, 0)
        ahead = (self.total[x + z] - self.total[x]) * self.up[np.where(inside, lag, 0)]
        return inside & (ahead == self.total[y + z] - self.total[y])

    def extended(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch with period ``lag`` around each ``at``."""
        left, right = np.zeros_like(at), np.zeros_like(at)
        step = 1 << max(self.n - 1, 1).bit_length()
        while step:
            right += step * self.same(at + right, lag, step)
            left += step * self.same(at - left - step, lag, step)
            step //= 2
        return at - left, at + right + lag


def seeds(spans: Spans, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minimizers, the distance from ``scale`` up to twice it."""
    grams = spans.grams(2 * scale)
    if len(grams) <= scale:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _spread(grams, scale, np.minimum)  # of the windows
    # a gram is chosen if it is the least of a window that holds it
    edge = np.zeros(scale - 1, np.uint64)
    chosen = np.flatnonzero(_spread(np.concatenate([edge, least, edge]), scale, np.maximum) == grams)
    order = chosen[np.argsort(grams[chosen], kind="stable")]
    gap = np.diff(order)
    kept = (np.diff(grams[order]) == 0) & (gap >= scale) & (gap < 2 * scale)
    return order[:-1][kept], gap[kept]


def scale_scan(words: np.ndarray, scale: int) -> np.ndarray:
    """Stretches with periods from ``scale`` up to 2 * ``scale`` - 1, seeded by minimizers."""
    if len(words) < TIMES * scale:
        return _EMPTY
    spans = Spans(words)
    at, lag = seeds(spans, scale)
    if not len(at):
        return _EMPTY
    start, end = spans.extended(at, lag)
    found = np.unique(np.stack([start, end, lag], axis=1)[end - start >= TIMES * lag], axis=0)
    wrong = [q for s, e, q in found.tolist() if not _is_run(words, s, e, q)]
    if wrong:  # two spans of one hash: their lags are scanned word by word
        found = np.concatenate([found[~np.isin(found[:, 2], wrong)], *(lag_scan(words, q) for q in set(wrong))])
    return found


def _is_run(words: np.ndarray, start: int, end: int, lag: int) -> bool:
    return (np.array_equal(words[start : end - lag], words[start + lag : end])
            and (start == 0 or words[start - 1] != words[start + lag - 1])
            and (end == len(words) or words[end] != words[end - lag]))


def runs(texts: list[list[int]]) -> list[np.ndarray]:
    """The (start, length, period) of all runs of each text of numbered words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.fromiter(chain.from_iterable(chain(t, (-1 - k,)) for k, t in enumerate(texts)), np.int64, first[-1])
    found = [lag_scan(words, q) for q in range(1, SHORTEST) if len(words) > q]
    places, scale = np.arange(len(words)), SHORTEST
    while scale * TIMES <= sizes.max(initial=0):
        long = np.repeat(sizes >= TIMES * scale, sizes + 1)
        words, places = words[long], places[long]
        sizes = sizes[sizes >= TIMES * scale]
        here = scale_scan(words, scale)
        found.append(np.stack([places[here[:, 0]], places[here[:, 1] - 1] + 1, here[:, 2]], axis=1))
        scale *= 2
    every = np.concatenate([_EMPTY, *found])
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    fresh = np.ones(len(every), bool)  # the shortest period of a stretch
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[fresh]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    of = np.searchsorted(first, every[:, 0], "right") - 1
    out = np.stack([every[:, 0] - first[of], every[:, 1] - every[:, 0], every[:, 2]], axis=1)
    return np.split(out, np.searchsorted(of, np.arange(1, len(texts))))


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words less those of runs after their first period, joined by one space."""
    if len(found):
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, found[:, 0] + found[:, 2], 1)
        np.add.at(marks, found[:, 0] + found[:, 1], -1)
        words = compress(words, (np.cumsum(marks) == 0).tolist())
    return b" ".join(words)


def find(df: DataFrame, text: str = "text", found: str = "runs", shortened: str = "collapsed") -> DataFrame:
    """Add the runs of ``text`` (start, length, period in words) and the text with each run cut to one period."""

    def make():
        def some(texts: pa.Array) -> list[tuple[np.ndarray, bytes]]:
            words = [t.encode().split() if t else [] for t in texts.to_pylist()]
            number = Numbering()
            here = runs([list(map(number.__getitem__, w)) for w in words])
            return [(r, collapsed(w, r)) for w, r in zip(words, here, strict=True)]

        def fn(batch):
            rows = some(batch.column(text))
            offsets = np.cumsum([0, *(len(r) for r, _ in rows)], dtype=np.int32)
            flat = np.concatenate([_EMPTY, *(r for r, _ in rows)])
            values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.fieldNames())
            return [pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([c for _, c in rows], pa.binary()).cast(pa.string())]

        return fn

    return append(df, [T.StructField(found, T.ArrayType(RUN)), T.StructField(shortened, T.StringType())], make)
