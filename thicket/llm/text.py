"""Words and hashes of Arrow text columns, computed on whole byte buffers.

Everything here works inside a Python worker on one Arrow batch. Texts are taken
as UTF-8 bytes; no Python string is made for a word. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes that are worked on at once; a longer text is a slice of its own.
SLICE = 1 << 20
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def giving_back(run: Callable) -> Callable:
    """Wrap a function of Arrow batches so that its worker gives free memory back when a task ends; workers stay for later tasks."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return wrapped


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each text (one more at the end)."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(column) else (bytes_[:0], np.zeros(1, np.int64))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of whole texts of about size bytes: first, last + 1, bytes, offsets."""
    data, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Words are runs of anything but these separators.
SPACE = byte_set(b" \t\n\v\f\r")
WORD = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Lower case, with a space for each separator.
SPACED = np.where(WORD, LOWER, 32).astype(np.uint8)


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of members that do not cross text borders: starts, ends, and the first run of each text."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    borders = offsets[1:-1]
    borders = borders[borders < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = member[:-1]
    before[borders] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[borders[borders > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) words with one space before each: bytes, starts (of the spaces), ends, and the first word of each text."""
    begins = offsets[:-1][np.diff(offsets) > 0]
    data = np.insert(np.take(SPACED, data), begins, 32)  # a text's first word has a space before it as well
    offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
    member = data != 32
    starts, ends, first = spans(member, offsets)
    to = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    if to[-1] < len(data):
        member[starts - 1] = True
        data = data[member]
    return data, to[:-1], to[1:], first


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE + 65536)
            self.up, self.down = (np.concatenate([np.ones(1, U64), np.multiply.accumulate(np.full(size - 1, b, U64))]) for b in (_BASE, _INVERSE))
        return self.up, self.down


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, whatever its place."""
    up, down = powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) words: hash, first word of each text, starts, ends."""
    starts, ends, first = spans(WORD[data], offsets)
    return span_hash(LOWER[data], starts, ends, powers), first, starts, ends


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; with fewer words, the whole sequence as one; none without words."""
    n = len(words)
    if not n:
        return words
    out = np.zeros(max(1, n - k + 1), U64)
    for j in range(min(k, n)):
        out = mix(out * U64(0x9FB21C651E98DF25) + words[j : j + len(out)])
    return out if n >= k else mix(out + U64(n))


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
