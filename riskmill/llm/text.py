"""Words of many texts at once, on NumPy arrays over the bytes of an Arrow column.

A word is a maximal run of bytes outside a set of separators, folded from A-Z to a-z when hashed.
Any piece of a text has a 64-bit hash: a polynomial over its bytes, taken from running sums, so that
words, their beginnings and whole lines are hashed without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Everything but ASCII letters, digits and the bytes of other scripts.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes of text that are worked on at once, and fewer where workers go on with other stages and keep what they touched.
SLICE, PART = 1 << 21, 1 << 19
#: Powers that are added at a time.
STEP = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix in which every bit of the input reaches every bit of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_byte = np.arange(256)
_byte = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 0x20, _byte)
BYTE_VALUE = mixed(_byte.astype(np.uint64) * np.uint64(2) + np.uint64(0x1234567))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse, kept for the next call."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(-(-n // STEP) * STEP, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes; one longer text is a run."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def chunks(batches: Iterable[pa.RecordBatch], size: int, column: str = "text") -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with about `size` bytes of text, numbered within the partition."""
    held, held_bytes, number = [], 0, 0
    for batch in batches:
        for part in slices(batch, column, size):
            held.append(part)
            held_bytes += part.column(column).nbytes
            if held_bytes >= size:
                table = pa.Table.from_batches(held).combine_chunks()
                held, held_bytes = [], 0
                yield number, table
                number += 1
    if held:
        yield number, pa.Table.from_batches(held).combine_chunks()


class Words:
    """Places and hashes of the words of a column of texts; NULL is an empty text.

    data: all bytes; text_at: where each text begins, and the end; start, end: of each word;
    word_at: the number of each text's first word, and the number of words; text_of: by word.
    """

    def __init__(self, texts: pa.Array, separator: np.ndarray = WHITE):
        flat = pc.fill_null(texts.cast(pa.large_binary()), b"")
        _, at, data = flat.buffers()
        at = np.frombuffer(at, np.int64)[flat.offset : flat.offset + len(flat) + 1] if at else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.data, self.text_at = data[at[0] : at[-1]], at - at[0]
        inside = ~separator[self.data]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.text_at] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.word_at = np.searchsorted(self.start, self.text_at)
        self._sums: np.ndarray | None = None

    @classmethod
    def of(cls, data: np.ndarray) -> Words:
        """Bytes as one text without a word, of which pieces can be hashed."""
        return cls(pa.array([data.tobytes()], pa.large_binary()), np.ones(256, bool))

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.word_at)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.word_at) - 1), self.counts)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the bytes from start to end, A-Z as a-z."""
        up, down = powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(BYTE_VALUE[self.data] * up[: len(self.data)], out=self._sums[1:])
        sums = (self._sums[end] - self._sums[start]) * down[start]
        return mixed(sums + (end - start).astype(np.uint64) * np.uint64(BASE))

    def hashes(self) -> np.ndarray:
        """Of every word."""
        return self.hash(self.start, self.end)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of a sequence and one more item."""
    return mixed(first * np.uint64(BASE) + second + np.uint64(1))
