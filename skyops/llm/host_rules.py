"""Quality rules with verdicts by host.

Each document is measured and held against two base rules: too few words, or too many words in
repeated 5-word windows. Failures are summed by host (with partial sums, so a hot host is no
burden), the hosts' rates are shrunk towards a beta prior fitted to all hosts by moments, and
documents of hosts whose shrunk rate is above the limit are not kept.

Cases: null text counts as empty and fails as too short; a null host is no host, so its documents
are judged alone; with one host, or hosts that do not differ more than chance, the prior is as
strong as ``MOST_WEIGHT`` documents; an empty table gives no rows; repeated rows count once each;
added columns replace columns of the same names and other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.words import WINDOW, window_hashes, word_hashes
from skyops.session import cut_lineage

LEAST_WORDS, MOST_REPEATED = 10, 20
#: Hosts whose shrunk failure rate is above this lose all their documents.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_BLANK = " \t\n\v\f\r"
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SKIPPED = np.isin(np.arange(256), np.frombuffer(_BLANK.encode(), np.uint8)) | (np.arange(256) & 0xC0 == 0x80)


def repeated_words(words: np.ndarray) -> int:
    """Words that lie in a window found twice or more."""
    windows = window_hashes(words)
    if not len(windows):
        return 0
    _, at, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[at] > 1)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(steps)))


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    words = word_hashes(data, lower=False)
    lines = [s for s in (text or "").split("\n") if s.strip(_BLANK)]
    return (len(words), int(np.count_nonzero(~_SKIPPED[raw])), int(np.count_nonzero(_SYMBOL[raw])),
            len(lines) - len(set(lines)), repeated_words(words))


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of each text and ``base_failed``."""
    def make():
        def fn(batch):
            rows = [measure(t) for t in batch.column(text).to_pylist()]
            return [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(_COUNTS))]

        return fn

    counted = append(df, [T.StructField(c, T.LongType()) for c in _COUNTS], make)
    return counted.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                              | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def host_verdicts(counted: DataFrame, host: str) -> DataFrame:
    """(host, documents, failures, shrunk_rate, host_ok) of every host."""
    hosts = counted.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("documents")
    fitted = hosts.agg(F.sum("failures").alias("f"), F.sum("documents").alias("n"), F.avg(rate).alias("m"),
                       F.var_samp(rate).alias("v"), F.avg(1 / F.col("documents")).alias("c"))
    row = fitted.first()  # five sums over the hosts
    if not row["n"]:
        return hosts.select("host", "documents", "failures", F.lit(0.0).alias("shrunk_rate"), F.lit(True).alias("host_ok"))
    mean = row["f"] / row["n"]
    spread = (row["v"] or 0.0) - mean * (1 - mean) * row["c"]  # beyond what chance gives
    weight = max(min(mean * (1 - mean) / spread - 1, MOST_WEIGHT), LEAST_WEIGHT) if spread > 0 else MOST_WEIGHT
    shrunk = (F.col("failures") + mean * weight) / (F.col("documents") + weight)
    return hosts.select("host", "documents", "failures", shrunk.alias("shrunk_rate"),
                        (shrunk <= HOST_LIMIT).alias("host_ok"))


def judge(df: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``df`` without ``text``, with counts, ``base_failed``, the host's shrunk rate and ``kept``."""
    added = [*_COUNTS, "base_failed", "shrunk_rate", "kept", "host", "host_ok"]
    counted = with_counts(df, text).drop(text)
    counted = cut_lineage(counted.drop(*[c for c in added[6:] if c != host]))
    verdicts = host_verdicts(counted, host).select(F.col("host").alias("_host"), "shrunk_rate", "host_ok")
    judged = counted.join(verdicts, counted[host] == F.col("_host"), "left").drop("_host")
    kept = ~F.col("base_failed") & F.coalesce("host_ok", F.lit(True))
    return judged.withColumn("kept", kept).drop("host_ok")
