"""Vectorised words, lines and windows over Arrow text columns.

A word is a run of bytes other than space and 0x09-0x0D.  Texts stay in the Arrow buffer: one pass makes a
running polynomial sum over its bytes, from which the hash of any span (a word, a line, a 100-byte window)
follows by one subtraction.  Batches are cut into chunks of whole texts, so memory is bounded by the chunk
size or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SMALL_CHUNK = 1 << 18  # whose running sums stay in a core's cache
U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_RAW = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_FOLDED = _RAW[LOWER]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_P, _PINV)):
            steps = np.full(size, U(base))
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, a null as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


class Chunk:
    """Some whole texts of a batch: rows `first` to `last`, their bytes and where each begins."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray, fold: bool = True):
        self.first, self.n, self.data, self.at = first, len(at) - 1, data, at
        self.last = first + self.n
        self._fold, self._sums = fold, None

    def _sum(self) -> None:
        """The running sums, made when a hash is first asked for."""
        if self._sums is None:
            power, self._inverse = _upto(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            # `take` is twice as fast as places by bytes.
            weighed = (_FOLDED if self._fold else _RAW).take(self.data)
            weighed *= power[: len(self.data)]
            np.cumsum(weighed, out=self._sums[1:])

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self._sum()
        h = self._sums.take(end)
        h -= self._sums.take(start)
        h *= self._inverse.take(start)
        h ^= (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93)
        return mix(h)

    def windows(self, width: int) -> np.ndarray:
        """Raw hash of every `width` bytes; those across texts are the caller's to drop."""
        self._sum()
        n = len(self.data) - width + 1
        return mix((self._sums[width:] - self._sums[:n]) * self._inverse[:n]) if n > 0 else np.zeros(0, np.uint64)

    def words(self, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and for each text the index of its first word (one more at the end)."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.n + 1, np.int64)
        if separators is SPACE:
            word = (self.data != 32) & (self.data - np.uint8(9) > 4)
        else:
            word = ~separators.take(self.data)
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        edge = self.at[(self.at < n)]
        begins[edge] |= word[edge]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        edge = edge[edge > 0] - 1
        ends[edge] |= word[edge]
        start = np.flatnonzero(begins)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, self.at)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the newline-separated lines, and for each text the index of its first line."""
        cuts = np.flatnonzero(self.data == 10)
        counts = np.searchsorted(cuts, self.at[1:]) - np.searchsorted(cuts, self.at[:-1]) + 1
        first = np.concatenate([[0], np.cumsum(counts)])
        owner = np.repeat(np.arange(self.n), counts)
        rank = np.arange(len(owner)) - first[owner]
        cut_first = np.searchsorted(cuts, self.at[:-1])
        start = np.where(rank == 0, self.at[owner], 0)
        later = rank > 0
        start[later] = cuts[(cut_first[owner] + rank - 1)[later]] + 1
        end = np.empty_like(start)
        last = rank == counts[owner] - 1
        end[last] = self.at[owner[last] + 1]
        end[~last] = cuts[(cut_first[owner] + rank)[~last]]
        return start, end, first

    def counts(self, table: np.ndarray) -> np.ndarray:
        """For each text, how many of its bytes `table` marks."""
        sums = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return sums[self.at[1:]] - sums[self.at[:-1]]


def chunks(column: pa.Array, fold: bool = True, size: int | None = None) -> Iterator[Chunk]:
    data, at = texts(column)
    size, first, n = size or CHUNK_BYTES, 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, side="right")) - 1)
        yield Chunk(first, data[at[first] : at[last]], at[first : last + 1] - at[first], fold)
        first = last


def word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = chunk.words()
    return chunk.span_hash(start, end), first


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct `width`-word windows of each text, sorted, and where each text's begin.

    A text of fewer words has its whole sequence as its one window; one without words has none.
    """
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    n = len(hashes)
    made, of = [], []
    if n >= width:
        total = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            total = total * U(0xC2B2AE3D27D4EB4F) + hashes[k : n - width + 1 + k]
        whole = owner[: n - width + 1] == owner[width - 1 :]
        made.append(mix(total[whole] + U(width)))
        of.append(owner[: n - width + 1][whole])
    for k in np.flatnonzero((count > 0) & (count < width)):
        total = np.zeros(1, np.uint64)
        for h in hashes[first[k] : first[k + 1]]:
            total = total * U(0xC2B2AE3D27D4EB4F) + h
        made.append(mix(total + U(int(count[k]))))
        of.append(np.full(1, k))
    if not made:
        return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
    value, text = np.concatenate(made), np.concatenate(of)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[keep], text[keep]
    return value, np.searchsorted(text, np.arange(len(count) + 1))
