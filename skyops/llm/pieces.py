"""The vocabulary of a merge-type (BPE) SentencePiece model, and merging by its scores.

Only models of one kind are taken: identity normalisation, a dummy prefix, white space kept, byte
fallback, no user-defined or unused pieces, and no piece that continues past a word's end. ``load``
refuses any other.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass

SPACE = "▁"
#: Chunks up to this length are merged by scanning, longer ones with a heap.
_SCANNED = 200
_PROBES = ["", " ", "a  b", " x ", "\n", "\t　ａ①é", "<s></s><unk><0x0A>", "▁a", "a\r\nb\x00"]


@dataclass(frozen=True)
class Vocabulary:
    """``ranks``: of each piece, lower merges first; ``single``: pieces that encode alone as one."""

    ids: dict[str, int]
    ranks: dict[str, float]
    single: frozenset[str]
    raw: list[bytes]
    byte_ids: list[int]
    end_id: int
    closed: str  # characters that no piece has before one outside this set
    digest: str  # of the model file


class Memory(dict):
    """A dict that computes what it lacks and keeps two generations of at most ``size`` entries.

    Texts longer than ``longest`` are not kept; without it keys are of any kind.
    """

    def __init__(self, compute, size: int, longest: int | None = 64):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if self.longest is None or len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def load(path: str) -> Vocabulary:
    """Read a model file (about a megabyte) and prove which pieces encode alone as one token."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    special = {i for i in range(n) if sp.is_unknown(i) or sp.is_control(i)}
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    ids = {sp.id_to_piece(i): i for i in range(n) if i not in special and not sp.is_byte(i)}
    if any(sp.is_unused(i) for i in ids.values()) or not all(sp.is_byte(i) for i in byte_ids):
        raise ValueError(f"{path}: not a merge-type model with byte fallback")
    if any(re.search(f"[^{SPACE}\n]{SPACE}|.\n|\n.", p) for p in ids) or any(c not in ids for p in ids for c in p):
        raise ValueError(f"{path}: pieces span words, or are made of unknown characters")
    raw = [b""] * n
    for p, i in ids.items():
        raw[i] = p.replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        raw[i] = bytes([b])
    ranks = {p: -sp.get_score(i) for p, i in ids.items()}
    single = frozenset(p for p in ids if merge(p, ranks) == [p])
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    vocab = Vocabulary(ids, ranks, single, raw, byte_ids, sp.eos_id(), _closed(ids), digest)
    split = splitter(vocab)
    for text in _PROBES:
        if [i for c in split(text) for i in merged_ids(c, vocab)] != sp.encode(text):
            raise ValueError(f"{path}: normalises text, or is not a merge-type model")
    return vocab


def _closed(pieces) -> str:
    """The largest set of letters and digits that no piece has before a character outside the set."""
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:])}
    closed = {a for pair in pairs for a in pair if a.isalnum()}
    while open_ := {a for a, b in pairs if a in closed and b not in closed}:
        closed -= open_
    return "".join(sorted(closed))


def splitter(vocab: Vocabulary):
    """The function that cuts a text into chunks: no piece spans two, so each is encoded on its own.

    A chunk is a run of spaces, then other characters, then closed ones; or one line feed.
    """
    m = re.escape(vocab.closed) or "\n"
    chunk = re.compile(rf"{SPACE}*[^{SPACE}\n{m}]*[{m}]+|{SPACE}*[^{SPACE}\n{m}]+|{SPACE}+|\n").findall
    return lambda text: chunk(SPACE + text.replace(" ", SPACE)) if text else []


def merge(text: str, ranks: dict[str, float]) -> list[str]:
    """Characters joined pair by pair, best rank first and leftmost among equals."""
    if len(text) > _SCANNED:
        return _merge_long(text, ranks)
    part, none = list(text), float("inf")
    rank = [ranks.get(a + b, none) for a, b in zip(part, part[1:])]
    while rank and (best := min(rank)) != none:
        i = rank.index(best)
        part[i : i + 2] = [part[i] + part[i + 1]]
        del rank[i]
        if i < len(rank):
            rank[i] = ranks.get(part[i] + part[i + 1], none)
        if i:
            rank[i - 1] = ranks.get(part[i - 1] + part[i], none)
    return part


def _merge_long(text: str, ranks: dict[str, float]) -> list[str]:
    part: list = list(text)
    end = len(part)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    heap = [(ranks[p], i, p) for i in range(end - 1) if (p := part[i] + part[i + 1]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, piece = heapq.heappop(heap)
        j = after[i] if part[i] is not None else end
        if j >= end or part[i] + part[j] != piece:
            continue
        part[i], part[j], after[i] = piece, None, after[j]
        if after[j] < end:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < end and (p := part[left] + part[right]) in ranks:
                heapq.heappush(heap, (ranks[p], left, p))
    return [p for p in part if p is not None]


def merged_ids(chunk: str, vocab: Vocabulary) -> list[int]:
    """Ids of a chunk by merging alone; characters outside the vocabulary become bytes."""
    out: list[int] = []
    for p in merge(chunk, vocab.ranks):
        if p in vocab.ids:
            out.append(vocab.ids[p])
        else:
            out.extend(vocab.byte_ids[b] for b in p.encode())
    return out
