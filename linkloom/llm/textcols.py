"""Word and line tables of Arrow text columns, computed on the bytes without a Python object per word.

A word is a run of bytes other than space and 0x09 to 0x0D, so multi-byte characters stay whole. Words, lines
and windows are compared by 64-bit hashes: a polynomial over the bytes, mixed. Within one text two
different words share a hash with a chance of about 1 in 10^13, which the operators accept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix generator: spreads every input bit over all 64."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, ``n`` of each at least."""
    global _powers
    if n > len(_powers[0]):
        size = max(n, 1 << 16)
        both = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        if size > 4 * SLICE_BYTES:  # one very long text: don't keep its table
            return both[0], both[1]
        _powers = (both[0], both[1])
    return _powers


def runs(mask: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True. ``breaks``: positions at which a run is cut as well."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    if breaks is not None:
        inner = breaks[(breaks > 0) & (breaks < n)]
        first[inner] = mask[inner]
        last[inner - 1] = mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


@dataclass
class Texts:
    """UTF-8 bytes of some texts one after the other; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray
    _sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range; equal ranges have equal hashes wherever they stand."""
        up, down = powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words and the number of the text that each stands in."""
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        starts, ends = runs(~blank, self.bounds)
        return starts, ends, self.owner(starts)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the lines (cut at ``\\n``, which belongs to none) and their text's number."""
        cuts = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.bounds[:-1], cuts + 1])
        texts = np.concatenate([np.arange(len(self)), self.owner(cuts)])
        order = np.lexsort((starts, texts))
        starts, texts = starts[order], texts[order]
        ends = np.empty_like(starts)
        same = texts[1:] == texts[:-1]
        ends[:-1] = np.where(same, starts[1:] - 1, self.bounds[1:][texts[:-1]])
        if len(ends):
            ends[-1] = self.bounds[1:][texts[-1]]
        return starts, ends, texts

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1


def texts_of(column: pa.Array) -> Texts:
    """The texts of an Arrow string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text comes alone. Bounds memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        filled = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = filled[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(filled, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def repeats(text: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether its text has it twice or more, and whether it stood earlier in the same text."""
    n = len(keys)
    twice, later = np.zeros(n, bool), np.zeros(n, bool)
    if n > 1:
        order = np.lexsort((keys, text))
        same = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        later[order[1:][same]] = True  # lexsort is stable: the first of equal keys comes first
    return twice, later


def windows(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the ``size``-word windows that lie in one text, and the windows' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * _BASE + words[k : k + n]
    starts = np.flatnonzero(text[:n] == text[size - 1 :])
    return starts, mix(h[starts])


def counts(text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Number (or sum of weights) per text."""
    out = np.bincount(text, weights, minlength=n)
    return np.rint(out).astype(np.int64) if weights is not None else out.astype(np.int64)

