"""Word hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(BASE))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWERED = _BYTE[_LOWER]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    out = np.full(n, _INVERSE if inverse else BASE, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """The powers up to the longest slice so far, kept for the worker's next batch."""

    up = down = np.ones(1, _U)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = powers(n), powers(n, True)
        return cls.up[:n], cls.down[:n]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a space after each text, and where each text starts."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8), starts


def _slices(space: np.ndarray):
    """Ranges of about ``SLICE_BYTES`` that end after white space."""
    at = 0
    while at < len(space):
        end = min(len(space), at + SLICE_BYTES)
        while end < len(space) and not space[end - 1]:
            more = np.flatnonzero(space[end : end + SLICE_BYTES])
            end = min(len(space), end + (more[0] + 1 if len(more) else SLICE_BYTES))
        yield at, end
        at = end


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the index of its first word (one more at the end).

    Words are the runs between ASCII white space; ``lower`` folds A-Z.
    """
    buffer, text_starts = joined(texts)
    table = _LOWERED if lower else _BYTE
    hashes, starts = [], []
    space = _SPACE[buffer]
    for a, b in _slices(space):
        part, gap = buffer[a:b], space[a:b]
        up, down = _Powers.get(len(part) + 1)
        total = np.zeros(len(part) + 1, _U)
        np.cumsum(table[part] * up[:-1], out=total[1:])
        before = np.concatenate([[True], gap[:-1]])
        first = np.flatnonzero(before & ~gap)
        last = np.flatnonzero(gap & ~before)
        hashes.append(mix((total[last] - total[first]) * down[first]))
        starts.append(first + a)
    found = np.concatenate(hashes) if hashes else np.empty(0, _U)
    at = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return found, np.searchsorted(at, text_starts)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int):
    """Hashes of each text's word ``size``-grams and the text of each.

    A text of fewer words, but not none, has one shingle of all its words.
    """
    counts = np.diff(offsets)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[:-1], n)
    end = np.repeat(offsets[1:], n)
    value = np.zeros(len(first), _U)
    for k in range(size):
        at = first + k
        inside = at < end
        word = words[np.minimum(at, max(len(words) - 1, 0))] if len(words) else value
        value = np.where(inside, mix(value * _U(BASE) + word + _U(k + 1)), value)
    return value, text
