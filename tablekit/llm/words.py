"""Vectorised words of many texts: positions and 64-bit hashes, no Python strings."""

from __future__ import annotations

import numpy as np

from .base import Texts

_R = np.uint64(0x9E3779B97F4A7C15)            # odd, so it has an inverse modulo 2^64
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_PIECE = 1 << 17                              # bytes hashed at once, few enough for the processor's cache


class _Kept(dict):
    """What a process has computed. Functions are sent to tasks with their module's
    values; this one goes empty, as it is large (2 MB) and soon made."""

    def __reduce__(self):
        return _Kept, ()


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = _Kept()

#: Words of the Jaccard join: everything but space, tab, line feed, vertical tab, form feed, return.
BY_SPACE = np.zeros(256, bool)
BY_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Words of the models: ASCII letters and digits and all bytes of other characters.
BY_LETTER = np.ones(256, bool)
BY_LETTER[0x30:0x3A] = BY_LETTER[0x41:0x5B] = BY_LETTER[0x61:0x7B] = BY_LETTER[0x80:] = False
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower(data: np.ndarray, latin: bool = False) -> np.ndarray:
    """A-Z in lower case; with ``latin`` also the two-byte capitals U+00C0-U+00DE."""
    low = _ASCII_LOWER[data]
    if latin and len(low) > 1:
        cap = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][cap] += 0x20
    return low


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_PIECE, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        with np.errstate(over="ignore"):
            _POWERS[size] = tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, r)]))
                                  for r in (_R, _R_INV))
    return _POWERS[size]


def spans(low: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and after-last byte of every word; a word ends where its text ends."""
    if len(low) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = sep[low]
    cut = np.zeros(len(low) + 1, bool)
    cut[offs] = True
    word = ~out
    begin = word.copy()
    begin[1:] &= out[:-1] | cut[1:-1]
    end = word.copy()
    end[:-1] &= out[1:] | cut[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def hash_spans(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span, finalised."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # pieces keep the temporaries small
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, side="right")))
        a, b = starts[at], ends[to - 1]
        power, inverse = _powers(int(b - a))
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((low[a:b].astype(np.uint64) + np.uint64(1)) * power[:b - a], out=sums[1:])
        s, e = starts[at:to] - a, ends[at:to] - a
        out[at:to] = (sums[e] - sums[s]) * inverse[s]
        at = to
    return mix(out)


def words(texts: Texts, sep: np.ndarray, latin: bool = False):
    """``(hashes, first)``: text i has the words ``hashes[first[i]:first[i+1]]``."""
    low = lower(texts.data, latin)
    starts, ends = spans(low, texts.offs, sep)
    return hash_spans(low, starts, ends), np.searchsorted(starts, texts.offs)
