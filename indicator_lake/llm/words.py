"""Words, lines and their 64-bit hashes for whole Arrow batches of texts, with numpy only.

A word is a run of bytes other than space and 0x09-0x0D. All of these are single bytes in UTF-8, so words are
cut on bytes. Hashes are polynomial over the bytes (differences of one running sum) and mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # texts are handled in slices of about this size; one longer text is a slice of its own

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finisher of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U))
_LAG = mix(np.arange(1001, 1065, dtype=_U)) | _U(1)


class _Powers:
    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES + 1)
            cls.up = np.concatenate([np.ones(1, _U), np.multiply.accumulate(np.full(size, _BASE, _U))])
            cls.down = np.concatenate([np.ones(1, _U), np.multiply.accumulate(np.full(size, _BASE_INVERSE, _U))])
        return cls.up, cls.down


class Texts:
    """The bytes of some texts, joined, with the places of their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        word = ~SEPARATOR[data]
        before = np.empty_like(word)
        before[:1], before[1:] = False, word[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        after = np.empty_like(word)
        after[-1:], after[:-1] = False, word[1:]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        after[lasts] = False
        self.word = word
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i] to bounds[i + 1]

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """Hash of the bytes from starts to ends, pair by pair."""
        up, down = _Powers.upto(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE_VALUE[LOWER[self.data] if lower else self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        return self.hashes(self.starts, self.ends, lower)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k values (len - k + 1 of them; none when there are fewer values)."""
    if len(hashes) < k:
        return np.zeros(0, _U)
    n = len(hashes) - k + 1
    total = np.full(n, k, _U)
    for j in range(k):
        total += hashes[j : j + n] * _LAG[j]
    return mix(total)


def sliced(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, Texts]]:
    """(first row, texts) for consecutive slices of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, Texts(whole[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row])
        row = stop
