"""Vectorised byte-level helpers shared by the operators that run numpy inside Arrow tasks.

Nothing here knows about Spark: every function takes the bytes of one Arrow batch (or a
slice of a long text) and returns numpy arrays, so memory follows the batch, not the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers of the two polynomial hashes (any fixed odd 64-bit values do).
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_A = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_B = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = self._run(self.base, size)
            self.down = self._run(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)


POWERS_A, POWERS_B = Powers(BASE_A), Powers(BASE_B)


class RangeHash:
    """Hashes of any byte range of ``data`` in constant time each, from prefix sums."""

    def __init__(self, data: np.ndarray, powers: Powers = POWERS_A, table: np.ndarray = BYTE_A):
        up, self.down = powers.upto(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start]
                   + (np.asarray(end) - np.asarray(start)).astype(np.uint64))

    def of_width(self, width: int) -> np.ndarray:
        """Hash of every range of ``width`` bytes, by start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + np.uint64(width))


def text_views(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text of an Arrow column as uint8 views; null is empty."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        wide = pa.types.is_large_string(chunk.type) or pa.types.is_large_binary(chunk.type)
        _, offsets, data = chunk.buffers()
        off = np.frombuffer(offsets, np.int64 if wide else np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        valid = None if chunk.null_count == 0 else np.asarray(chunk.is_valid())
        for i in range(len(chunk)):
            yield raw[off[i]:off[i + 1]] if valid is None or valid[i] else raw[:0]


def blocks_of(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Cut ``range(len(sizes))`` into runs whose sizes add up to about ``limit`` (one item at least)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
