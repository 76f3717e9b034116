"""Words of texts as 64-bit hashes, computed by array operations over the UTF-8 bytes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Two words, or two runs of words,
count as equal if their hashes are; with 64 bits a false match within one comparison has a chance
of about 1 in 10**19 a pair.
"""

from __future__ import annotations

import numpy as np

WINDOW = 5

_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 - 2  # odd, and 3 modulo 8
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


class Powers:
    """Powers of the base and of its inverse, grown as texts need them."""

    up = down = np.ones(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            if n > 1 << 22:  # of a single very long text: not kept
                return _powers(_BASE, n), _powers(_INVERSE, n)
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers spread over all places."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(text: bytes, lower: bool) -> np.ndarray:
    """A hash for each word of one text, in order."""
    raw = np.frombuffer(text, np.uint8)
    if lower:
        raw = _LOWER[raw]
    edge = np.diff(~_SPACE[raw], prepend=False, append=False)
    at = np.flatnonzero(edge)
    if not len(at):
        return np.zeros(0, np.uint64)
    up, down = Powers.of(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up, out=total[1:])
    starts, ends = at[::2], at[1::2]
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def distinct(values: np.ndarray) -> np.ndarray:
    """The values in ascending order, each once."""
    out = np.sort(values)
    if len(out) < 2:
        return out
    fresh = np.empty(len(out), bool)
    fresh[0] = True
    np.not_equal(out[1:], out[:-1], out=fresh[1:])
    return out[fresh]


def window_hashes(words: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """A hash for each run of ``size`` words; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n] * _PLACE[0]
    for k in range(1, size):
        out = out + words[k : k + n] * _PLACE[k]
    return mix(out)


def shingle_set(text: str | None, size: int = WINDOW) -> np.ndarray:
    """The sorted distinct runs of ``size`` lower-cased words; of a shorter text, its words as one run."""
    words = word_hashes((text or "").encode(), lower=True)
    if 0 < len(words) < size:
        return window_hashes(words, len(words)) + np.uint64(len(words))
    return distinct(window_hashes(words, size))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    return [shingle_set(t) for t in texts]
