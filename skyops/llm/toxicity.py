"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, a text the mean of its
distinct words, and a softmax over two classes stands on top; vectors and softmax are trained together, by
adaptive gradient steps in numpy, so a misspelt word shares the vectors of the n-grams it keeps; the
weights are the mean over the ends of the later half of the rounds. The model learns from a bounded sample of labelled texts (``SAMPLE`` of each class, chosen by a hash of
the id), with the intercept set to the share of the class among all labels. Training happens on the
driver and gives one number for each n-gram bucket, which is all that scoring needs.

Cases: null and empty texts, and texts without a letter or digit, get the score of the intercept
alone; labels that are null, not 0 or 1, or of ids without text are not used and take no place in the
sample; of several texts under one id the least is learned from; if the texts to learn from
are of one class every score is next to that class, and next to 0 if there are none; rows with equal ids or texts
are scored each; a very long text is scored whole; ``df`` keeps its other columns.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.pieces import Memory

#: Labelled texts of each class that are learned from.
SAMPLE = 1_500
BUCKETS, WIDTH = 1 << 17, 8
SHORTEST, LONGEST = 3, 6
ROUNDS, STEP, SHRINK = 8, 0.3, 1e-6
LIMIT = 0.3
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams(word: str) -> list[int]:
    """Buckets of a word's n-grams, begin and end marked, and of the word."""
    w = f"<{word}>"
    parts = [w[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(w) - n + 1) if n < len(w)]
    return [zlib.crc32(p.encode()) % BUCKETS for p in [*parts, w]]


@dataclass(frozen=True)
class Model:
    """``weights``: of each bucket, how far its vector moves the log odds of class 1."""

    weights: np.ndarray
    intercept: float

    def of_word(self, word: str) -> float:
        return float(self.weights[grams(word)].mean())


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text with their weights in its mean."""
    known: dict[str, np.ndarray] = {}
    out = []
    for t in texts:
        words = set(words_of(t))
        at, part = [], []
        for w in sorted(words):
            if w not in known:
                known[w] = np.array(grams(w), np.int32)
            at.append(known[w])
            part.append(np.full(len(known[w]), 1 / (len(words) * len(known[w]))))
        if at:
            ids, back = np.unique(np.concatenate(at), return_inverse=True)
            out.append((ids, np.bincount(back, np.concatenate(part)).astype(np.float32)))
        else:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
    return out


def train(texts: list[str], labels: list[int], share: float, seed: int = 7) -> Model:
    """Fit vectors and softmax jointly; ``share`` is how common label 1 is among all labels."""
    ones = sum(labels)
    if not ones or ones == len(labels):
        return Model(np.zeros(BUCKETS, np.float32), _log_odds(float(ones > 0)))
    rng = np.random.default_rng(seed)
    bags = _bags(texts)
    vectors = np.zeros((BUCKETS, WIDTH), np.float32)  # so n-grams never seen weigh nothing
    top = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    base = np.log(np.array([len(labels) - ones, ones], np.float32) / len(labels))
    seen = np.full(BUCKETS, 1e-12, np.float32)
    seen_top = np.full((WIDTH, 2), 1e-6, np.float32)
    weights = np.zeros(BUCKETS)
    for r in range(ROUNDS):
        for k in rng.permutation(len(bags)):
            ids, part = bags[k]
            own = vectors[ids]
            mean = part @ own
            odds = mean @ top + base
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[labels[k]] -= 1
            down = top @ p
            grad = np.outer(mean, p)
            seen_top += grad * grad
            top -= STEP * grad / np.sqrt(seen_top)
            seen[ids] += (part * part) * float(down @ down / WIDTH)
            vectors[ids] = own * (1 - SHRINK) - np.outer(STEP * part / np.sqrt(seen[ids]), down)
        if r >= ROUNDS // 2:
            weights += vectors @ (top[:, 1] - top[:, 0])
    weights /= ROUNDS - ROUNDS // 2
    return Model(weights.astype(np.float32), _log_odds(share))


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return math.log(share / (1 - share))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from ``labels`` (doc_id, label) of the texts in ``docs``."""
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("id")).agg(F.max(label).alias("label"))
    known = known.join(texts.select("id"), "id", "left_semi")
    counts = dict(known.groupBy("label").count().collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    chosen = None
    for c in (0, 1):
        own = known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = own if chosen is None else chosen.unionByName(own)
    # at most twice the sample: one text for each id, the least of several
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect()
    rows = sorted(rows, key=lambda r: r["id"])
    return train([r["text"] for r in rows], [int(r["label"]) for r in rows], share)


def score(df: DataFrame, model: Model, text: str = "text", limit: float = LIMIT, score: str = "score",
          predicted: str = "predicted") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``limit``) under these names."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        known = Memory(m.of_word, REMEMBERED)

        def odds(t):
            words = set(words_of(t))
            return m.intercept + (sum(map(known.__getitem__, words)) / len(words) if words else 0.0)

        def fn(batch):
            x = np.array([odds(t) for t in batch.column(text).to_pylist()], np.float64)
            return [pa.array(1 / (1 + np.exp(-np.clip(x, -500, 500))), pa.float64())]

        return fn

    scored = append(df, [T.StructField(score, T.DoubleType())], make)
    return scored.withColumn(predicted, (F.col(score) >= limit).cast("int"))
