"""Words, lines and hashes of many texts at once, as numpy arrays over UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 * 1024 * 1024
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(start: int, count: int) -> np.ndarray:
    """A fixed sequence of pseudo-random 64-bit integers."""
    return mix((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(start)) * np.uint64(_BASE))


_BYTE_VALUES = stream(7, 256)
_ORDER = stream(1013, 64) | np.uint64(1)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(size, np.uint64(base), dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for at least ``size`` positions."""
    return _powers(1 << max(12, int(size).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any byte range follows; one more entry than bytes."""
    up, _ = powers(data.size + 1)
    sums = np.zeros(data.size + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: data.size], out=sums[1:])
    return sums


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range; ranges are sorted and don't overlap.

    Works through the bytes in blocks that begin at a range, so a very long text costs
    memory for one block beside its ranges.
    """
    out = np.empty(starts.size, dtype=np.uint64)
    at = 0
    while at < starts.size:
        low = int(starts[at])
        until = max(at + 1, int(np.searchsorted(ends, low + CHUNK_BYTES, "right")))
        sums = prefix_hash(data[low : int(ends[until - 1])])
        s, e = starts[at:until] - low, ends[at:until] - low
        _, down = powers(sums.size)
        out[at:until] = (sums[e] - sums[s]) * down[s]
        at = until
    return mix(out)


def _flags(of: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(of)] = True
    return flags


SPACES = _flags(b"\x20\x09\x0a\x0b\x0c\x0d")
NOT_SPACES = ~SPACES
# ASCII letters and every byte of a longer code point.
LETTERS = _flags(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


@dataclass
class Texts:
    """The bytes of some texts, one after another; ``offsets`` has one more entry than texts."""

    data: np.ndarray
    offsets: np.ndarray
    inside: np.ndarray = None  # which byte values belong to words

    def __len__(self) -> int:
        return self.offsets.size - 1

    @cached_property
    def _word_bytes(self) -> np.ndarray:
        return (NOT_SPACES if self.inside is None else self.inside)[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words, in bytes."""
        word = self._word_bytes
        first = np.zeros(self.data.size + 1, dtype=bool)
        first[self.offsets] = True
        before = np.zeros(self.data.size, dtype=bool)
        before[1:] = word[:-1]
        after = np.zeros(self.data.size, dtype=bool)
        after[:-1] = word[1:]
        starts = np.flatnonzero(word & ~(before & ~first[:-1]))
        ends = np.flatnonzero(word & ~(after & ~first[1:])) + 1
        return starts, ends

    @cached_property
    def word_offsets(self) -> np.ndarray:
        """Where each text's words begin among all words."""
        return np.searchsorted(self.words[0], self.offsets)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return range_hashes(self.data, *self.words)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        sums = np.zeros(flags.size + 1, dtype=np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` words in a row, and where each text's begin.

        A text of fewer words, but one at least, has one shingle of all its words.
        """
        hashes, offsets = self.word_hashes, self.word_offsets
        counts = np.diff(offsets)
        many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        bounds = np.concatenate([[0], np.cumsum(many)])
        owner = np.repeat(np.arange(counts.size), many)
        at = np.arange(bounds[-1]) - bounds[owner] + offsets[owner]
        out = np.zeros(at.size, dtype=np.uint64)
        padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
        for k in range(size):
            value = padded[at + k] * _ORDER[k]
            if k:
                value[k >= counts[owner]] = 0
            out += value
        return mix(out), bounds


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1] or b"\0" * 8, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not offsets.size:
        offsets = np.zeros(1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(column: pa.Array, inside: np.ndarray | None = None, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Runs of rows of about ``limit`` bytes together; a longer text stands alone, whole."""
    data, offsets = string_parts(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, len(column))
        part = offsets[low : high + 1]
        yield low, high, Texts(data[part[0] : part[-1]], part - part[0], inside)
        low = high


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
