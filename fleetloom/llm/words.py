"""Words and word windows of many texts at once, as numpy arrays inside a task.

A word is a run of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``; a null text has
none. Hashes are polynomials modulo 2**64 over mixed values, so the hash of any window
is the difference of two prefix sums.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Texts are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
OTHER_BASE = 0xA0761D6478BD642F


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every bit over all others."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full((2, max(n, 1 << 16)), [[self.base], [self.inverse]], dtype=U64)
            steps[:, 0] = 1
            self.up, self.down = np.cumprod(steps, axis=1, dtype=U64)
        return self.up[:n], self.down[:n]


_POWERS: dict[int, Powers] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _POWERS.setdefault(base, Powers(base)).of(n)


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The hash of ``values[start:end]`` for every span."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    up, down = _powers(base, len(values) + 1)
    prefix = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[: len(values)], out=prefix[1:], dtype=U64)
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def windows_hash(values: np.ndarray, size: int, base: int = WORD_BASE) -> np.ndarray:
    """The hash of every window of ``size`` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    starts = np.arange(n)
    return spans_hash(values, starts, starts + size, base)


def byte_spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BYTE_BASE) -> np.ndarray:
    """The hash of ``data[start:end]`` for every span, over a bounded run of bytes at a time."""
    out = np.empty(len(starts), dtype=U64)
    first = 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE_BYTES // 4, side="right")))
        low, high = starts[first], ends[last - 1]
        out[first:last] = spans_hash(data[low:high].astype(U64) + U64(1), starts[first:last] - low, ends[first:last] - low, base)
        first = last
    return out


class Texts:
    """Words of a few texts: ``data`` holds the bytes, ``bounds`` the words of each text.

    ``starts`` and ``ends`` are byte places of the words; the words of text ``i`` are
    ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets
        black = ~WHITE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate(([False], black[:-1])) & ~edge[:-1]
        after = np.concatenate((black[1:], [False])) & ~edge[1:]
        self.starts = np.flatnonzero(black & ~before)
        self.ends = np.flatnonzero(black & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def word_hashes(self) -> np.ndarray:
        """A hash of each word, computed over a bounded run of bytes at a time."""
        return byte_spans_hash(self.data, self.starts, self.ends)

    def inside(self, size: int) -> np.ndarray:
        """For every window of ``size`` words, whether it lies in one text."""
        text = self.text_of_word
        n = len(text) - size + 1
        return text[:n] == text[size - 1 :] if n > 0 else np.zeros(0, dtype=bool)

    def window_text(self, size: int) -> np.ndarray:
        return self.text_of_word[: max(0, len(self.starts) - size + 1)]


@functools.cache
def _trimmer():
    """The GNU library's malloc_trim, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda pad: None


def release_memory() -> None:
    """Give freed memory back to the system.

    A Python worker stays for the tasks to come. What it keeps for itself is missing to the
    executor beside it.
    """
    pa.default_memory_pool().release_unused()
    _trimmer()(0)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``size`` bytes; after the last one, freed memory is given back."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    total, first = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield first, i
            first, total = i, 0
        total += int(n)
    if first < len(lengths):
        yield first, len(lengths)
    release_memory()


def bytes_of(column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of rows ``first`` to ``last``, and where each row's begin and end."""
    part = pc.fill_null(column.slice(first, last - first).cast(pa.large_binary()), b"")
    part = pa.concat_arrays([part])
    offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
    values = part.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(column: pa.Array, first: int, last: int, lower: bool = False) -> Texts:
    """The words of rows ``first`` to ``last``."""
    return Texts(*bytes_of(column, first, last), lower)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
