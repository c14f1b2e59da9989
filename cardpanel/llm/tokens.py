"""Words and word hashes of a whole Arrow text column at once.

The UTF-8 buffer of the column is scanned with numpy: no Python string is made
per word.  A word is a maximal run of bytes that are not delimiters, inside one
text.  Its hash is 64 bits of a polynomial over random byte values, finished by
a mixer; equal words hash equally on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes hashed at a time (eight-byte temporaries of this length).
PIECE = 1 << 19

# The delimiters of the word definitions, as byte classes.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x80] = True
NON_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 32

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=U)
_P = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, PIECE), _powers(_P_INV, PIECE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place)."""
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


@dataclass
class Words:
    """Words of some consecutive texts; ``doc`` counts from the first of them."""

    data: np.ndarray  # bytes of these texts
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]
    hash: np.ndarray | None

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts())


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null reads as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Hash of each word, some hundred kilobytes at a time (a longer word alone)."""
    out, table = np.empty(len(start), U), _BYTE[fold]
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        up, down = (_POW, _INV) if hi - lo <= PIECE else (_powers(_P, hi - lo), _powers(_P_INV, hi - lo))
        total = np.empty(hi - lo + 1, U)
        total[0] = 0
        np.cumsum(table[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(U)
        i = j
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray, delimiters: np.ndarray = SPACES, fold: np.ndarray = AS_IS,
          hashed: bool = True) -> Words:
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = ~delimiters[data]
    begins, ends = inside.copy(), np.empty(len(data) + 1, bool)
    # a word begins where the byte before is a delimiter or another text's
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    ends[:-1] = ~inside | begins
    ends[-1] = True
    ends[offsets] = True
    ends[1:-1] &= inside[:-1]
    ends[-1] = len(data) > 0 and inside[-1]
    ends[0] = False
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    return Words(data, offsets, start, end, first, hashes(data, start, end, fold) if hashed else None)


def slices(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive texts [lo, hi) of about ``size`` bytes together (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_slices(col: pa.Array, delimiters: np.ndarray = SPACES, fold: np.ndarray = AS_IS, hashed: bool = True,
                size: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """The column's words, some texts at a time: (first row, end row, words)."""
    data, offsets = buffers(col)
    for lo, hi in slices(offsets, size):
        yield lo, hi, words(data, offsets[lo : hi + 1], delimiters, fold, hashed)


_ORDER = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (fewer words: none)."""
    if len(h) < k:
        return np.empty(0, U)
    n = len(h) - k + 1
    total = h[:n] * _ORDER[0]
    for i in range(1, k):
        total += h[i : i + n] * _ORDER[i]
    return mix(total)
