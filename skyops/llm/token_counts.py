"""Token counts without encoding: pre-tokens that are one token are counted directly.

Which vocabulary strings encode alone as one token is proven once, on the driver, by merging each
of them (``pieces.load``). A text is cut into pre-tokens that no piece spans; one that is a proven
string counts 1, and only the rest are merged.

Cases: null text counts as empty; empty text has 0 bytes and 0 tokens; strings of special tokens
are ordinary text; a very long word is merged on its own and not remembered; added columns replace
columns of the same names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.pieces import Memory, Vocabulary, load, merge, splitter

#: Merged pre-tokens that a task remembers, in each of two generations.
REMEMBERED = 300_000


def counter(vocab: Vocabulary):
    """The function that counts the tokens of a text."""
    known, single, split = vocab.ids, vocab.single, splitter(vocab)

    def tokens(chunk: str) -> int:
        if chunk in single:
            return 1
        return sum(1 if p in known else len(p.encode()) for p in merge(chunk, vocab.ranks))

    counts = Memory(tokens, REMEMBERED)
    return lambda text: sum(map(counts.__getitem__, split(text)))


def count_tokens(df: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of ``text``, without begin or end ids."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def make():
        count = counter(shared.value)

        def fn(batch):
            rows = batch.column(text).to_pylist()
            return [pa.array([count(t or "") for t in rows], pa.int64())]

        return fn

    return append(df, [T.StructField(n_tokens, T.LongType())], make)
