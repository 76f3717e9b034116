"""SentencePiece encoding and decoding.

Encoding is exact for merge-type models without running the merges over a text: an Aho-Corasick
pass finds the longest piece from each position, pieces are laid one after another, a piece may
follow another only if merging the two strings again gives just these two, and a bit marks each
position from which no piece leads on, so that it is tried once.

Cases: null text counts as empty; empty text gives the end id alone and decodes to empty; decoding
null ids gives an empty text; unknown ids fail; a very long word is one chunk, encoded in linear
time and not remembered; repeated rows give equal results; added columns replace columns of the
same names and other columns stay.
"""

from __future__ import annotations

import codecs
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skyops.llm.batches import append
from skyops.llm.pieces import Memory, Vocabulary, load, merge, splitter

#: Chunks and pairs of pieces that a worker process remembers, in each of two generations.
REMEMBERED, PAIRS = 100_000, 150_000


class Encoder:
    """Encodes chunks by backtracking over the pieces that encode alone as one token."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        self.vocab = vocab
        self.characters = {p for p in vocab.ids if len(p) == 1}
        single = {p: vocab.ids[p] for p in vocab.single}
        self.automaton = ahocorasick.Automaton()
        for p, i in single.items():
            self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        self.length = {i: len(p) for p, i in single.items()}
        #: of each piece, the longest piece that is a proper prefix
        self.shorter = {i: next((single[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in single), None)
                        for p, i in single.items()}
        text_of = {i: p for p, i in single.items()}
        self.shift = max(single.values()).bit_length()

        def apart(pair):
            left, right = text_of[pair >> self.shift], text_of[pair & ((1 << self.shift) - 1)]
            return merge(left + right, vocab.ranks) == [left, right]

        #: whether two pieces, the ids of which make one number, stay apart when their string is merged again
        self.fits = Memory(apart, PAIRS, None)
        #: the ids of chunks as bytes
        self.known = Memory(lambda chunk: array("i", self.ids(chunk)).tobytes(), REMEMBERED)

    def known_ids(self, text: str) -> list[int]:
        """The ids of a text of known characters."""
        n = len(text)
        longest: list[int | None] = [None] * (n + 1)
        for end, (back, i) in self.automaton.iter(text):
            longest[end - back] = i  # ends ascend, so the last one is the longest
        failed = None  # a bit for each position, once there is one from which no piece leads on
        length, shorter, fits, shift = self.length, self.shorter, self.fits, self.shift
        out: list[int] = []
        at, last, piece = 0, None, longest[0]
        while at < n:
            while piece is not None:
                end = at + length[piece]
                if (failed is None or not failed[end >> 3] >> (end & 7) & 1) and (last is None or fits[last << shift | piece]):
                    break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                at, last, piece = end, piece, longest[end]
            else:
                failed = failed or bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                at -= length[last]
                piece = shorter[out.pop()]
                last = out[-1] if out else None
        return out

    def ids(self, chunk: str) -> list[int]:
        if self.characters.issuperset(chunk):
            return self.known_ids(chunk)
        out, start = [], 0
        for i, c in enumerate(chunk):
            if c not in self.characters:
                out += self.known_ids(chunk[start:i])
                out += [self.vocab.byte_ids[b] for b in c.encode()]
                start = i + 1
        return out + self.known_ids(chunk[start:])


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(vocab: Vocabulary) -> Encoder:
    """The encoder of this worker process, which its tasks share with what it remembers; a new model replaces it."""
    if vocab.digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocab.digest] = Encoder(vocab)
    return _ENCODERS[vocab.digest]


def _encoding(vocab: Vocabulary, end: bool):
    """The function from an array of texts to their ids."""
    known, split = encoder_of(vocab).known, splitter(vocab)
    tail = np.array([vocab.end_id], np.int32).tobytes() if end else b""

    def fn(texts: pa.Array) -> pa.ListArray:
        rows = [b"".join(map(known.__getitem__, split(t or ""))) + tail for t in texts.to_pylist()]
        offsets = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    return fn


def _each_byte(error):
    return "\ufffd" * (error.end - error.start), error.end


def _decoding(vocab: Vocabulary):
    """The function from an array of lists of ids to their texts."""
    raw = vocab.raw
    codecs.register_error("each-byte", _each_byte)

    def text_of(row):
        parts = [p for p in map(raw.__getitem__, row) if p]
        if parts and parts[0][:1] == b" ":
            parts[0] = parts[0][1:]
        return b"".join(parts).decode("utf-8", "each-byte")

    def fn(lists: pa.ListArray) -> pa.Array:
        return pa.array([text_of(r.values.to_numpy().tolist()) if r.is_valid else "" for r in lists], pa.string())

    return fn


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", end: bool = True) -> DataFrame:
    """Add the ids of ``text`` as an array, with the end id last if ``end``."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def make():
        fn = _encoding(shared.value, end)
        return lambda batch: [fn(batch.column(text))]

    return append(df, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of the array ``ids``: control ids give nothing, bytes that are no UTF-8 give U+FFFD each."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def make():
        fn = _decoding(shared.value)
        return lambda batch: [fn(batch.column(ids))]

    return append(df, [T.StructField(decoded, T.StringType())], make)


def encode_and_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
                      end: bool = True) -> DataFrame:
    """``encode``, then ``decode`` of its ids, in one worker process a task instead of two."""
    shared = df.sparkSession.sparkContext.broadcast(load(path))

    def make():
        there, back = _encoding(shared.value, end), _decoding(shared.value)

        def fn(batch):
            found = there(batch.column(text))
            return [found, back(found)]

        return fn

    return append(df, [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())], make)
