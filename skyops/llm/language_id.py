"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Lower-cased texts are turned into counts of hashed 1- to 3-grams, weighted log(1 + count) * idf and
scaled to length 1. Document frequencies are counted over all texts that may be learned from; the
classifier is trained on a bounded sample of them (about ``SAMPLE`` of each language, chosen by a
hash of id and text) by follow-the-regularised-leader with L1 and L2 penalties, so that most weights are
exactly zero. A temperature fitted on a part of the sample that training left out makes the
probabilities honest.

Cases: null texts and texts without a letter are ``und`` with score 0; rows without a language are
never learned from; with one language it is predicted everywhere, with none all texts are ``und``;
equal scores go to the language first in the alphabet; rows without an id, or with a common
one, are learned from like others; equal texts of a language are learned from once and count
once each in frequencies; a very long text is read whole; added columns replace columns of the same names and others stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.words import mix

LONGEST = 3
BUCKETS = 1 << 15
#: Texts of each language that are learned from, and the share of them kept for the temperature.
SAMPLE, KEPT = 800, 0.2
ROUNDS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"

_RNG = np.random.default_rng(20240503)
_PLACE = _RNG.integers(1, 2**63, LONGEST, dtype=np.uint64) | np.uint64(1)


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of a text, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(BUCKETS, np.int64)
    run = np.zeros(len(points), np.uint64)
    for n in range(min(LONGEST, len(points))):
        run = run[: len(points) - n] + points[n:] * _PLACE[n]
        total += np.bincount((mix(run) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = counts_of(text)
    x = np.log1p(n) * idf[at]
    size = math.sqrt(float(x @ x))
    return at, x / size if size else x


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket by language
    intercept: np.ndarray
    temperature: float

    def probabilities(self, text: str) -> np.ndarray:
        at, x = weighted(text, self.idf)
        return _softmax((x @ self.weights[at] + self.intercept) / self.temperature)


def _softmax(odds: np.ndarray) -> np.ndarray:
    e = np.exp(odds - odds.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader: per weight the sum of adjusted gradients and of their squares."""

    def __init__(self, rows: int, classes: int):
        self.z, self.n = np.zeros((rows, classes)), np.zeros((rows, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def step(self, at, grad: np.ndarray, used: np.ndarray) -> None:
        n = self.n[at]
        more = n + grad * grad
        self.z[at] += grad - (np.sqrt(more) - np.sqrt(n)) / ALPHA * used
        self.n[at] = more


def train(texts: list[str], langs: list[str], idf: np.ndarray, seed: int = 11) -> Model:
    names = sorted(set(langs))
    if not names:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    label = np.array([names.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    kept, learned = np.split(order, [int(KEPT * len(texts))])
    if len(set(label[learned])) < len(names):  # too few to leave any out
        kept = learned = order
    rows = [weighted(t, idf) for t in texts]
    lead, base = Leader(BUCKETS, len(names)), Leader(1, len(names))
    for _ in range(ROUNDS):
        for k in rng.permutation(learned):
            at, x = rows[k]
            w, b = lead.weights(at), base.weights([0])[0]
            p = _softmax(x @ w + b)
            p[label[k]] -= 1
            lead.step(at, x[:, None] * p, w)
            base.step([0], p[None], b[None])
    weights, intercept = lead.weights(slice(None)), base.weights([0])[0]
    odds = np.stack([rows[k][1] @ weights[rows[k][0]] + intercept for k in kept])
    return Model(names, idf, weights.astype(np.float32), intercept, _temperature(odds, label[kept]))


def _temperature(odds: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least log loss, by a search over a falling interval of its logarithm."""
    def loss(t):
        return -np.log(np.maximum(_softmax(odds / math.exp(t))[np.arange(len(label)), label], 1e-300)).sum()

    low, high = -3.0, 3.0
    while high - low > 1e-3:
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over all texts: in how many each bucket occurs, and how many there are."""
    def run(batches):
        found, n = np.zeros(BUCKETS + 1, np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                found[counts_of(t)[0]] += 1
                n += 1
        found[BUCKETS] = n
        at = np.flatnonzero(found)
        yield pa.record_batch([pa.array(at), pa.array(found[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in rows.collect():  # at most BUCKETS + 1
        out[bucket] = n
    return out[:BUCKETS], int(out[BUCKETS])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from every row of ``docs`` that has a text and a language."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    found, n = _document_frequencies(rows)
    idf = np.log((1 + n) / (1 + found)) + 1
    counts = dict(rows.groupBy("lang").count().collect())  # a row for each language, all of which the model holds
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, sample / n)]) if counts else None
    # by id and text, so that rows without an id or with a common one have places of their own
    place = F.xxhash64("id", "text").cast("double") / 2.0**64 + 0.5
    chosen = rows.where(place <= shares[F.col("lang")]) if counts else rows.limit(0)
    chosen = chosen.groupBy("lang", "text").agg(F.min("id").alias("id"))  # repeated rows share a place
    got = sorted(chosen.select("id", "text", "lang").collect(), key=lambda r: (r["lang"], r["id"] is not None, r["id"] or 0, r["text"]))
    return train([r["text"] for r in got], [r["lang"] for r in got], idf)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability of that language."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def one(t):
            if not m.languages or not has_letter(t):
                return UNKNOWN, 0.0
            p = m.probabilities(t)
            k = int(p.argmax())
            return m.languages[k], float(p[k])

        def fn(batch):
            rows = [one(t) for t in batch.column(text).to_pylist()]
            return [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())]

        return fn

    return append(df, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make)
