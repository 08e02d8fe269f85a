"""Wu-Manber multi-pattern search over bytes, with many cursors moving at once.

The block shift table says how far a cursor may jump when the block that ends its window
cannot end a pattern there; a shift of zero leads to the bucket of patterns whose window
ends with that block, and the bucket's patterns are compared byte by byte.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20
#: Patterns shorter than this go to a machine of their own, so that they don't shorten the jumps of the others.
SHORT = 24


class _Machine:
    def __init__(self, patterns: list[bytes], ids: list[int]):
        self.patterns, self.ids = patterns, ids
        self.window = min(map(len, patterns))
        self.block = min(8, self.window)
        self.mask = np.uint64(2 ** (8 * self.block) - 1)
        self.shift = np.full(1 << _BITS, self.window - self.block + 1, np.int32)
        heads = np.frombuffer(b"".join(p[:self.window] + b"\0" * 8 for p in patterns), np.uint8)
        view = _words(heads).copy()
        rows = np.arange(len(patterns)) * (self.window + 8)
        for end in range(self.block, self.window + 1):
            np.minimum.at(self.shift, self._slot(view[rows + end - self.block] & self.mask), self.window - end)
        self.buckets: dict[tuple[int, int], list[int]] = {}
        last = view[rows + self.window - self.block] & self.mask
        first = view[rows] & self.mask
        for i, key in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            self.buckets.setdefault(key, []).append(i)
        self.ends = np.unique(first ^ (last * _ODD))

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return ((x * _ODD) >> np.uint64(64 - _BITS)).astype(np.int64)

    def search(self, raw: bytes, view: np.ndarray, n: int, found: list[tuple[int, int]]) -> None:
        stop = n - self.window + 1
        if stop <= 0:
            return
        lanes = max(1, min(8192, stop // 2048))
        cut = np.linspace(0, stop, lanes + 1).astype(np.int64)
        pos, end, hits = cut[:-1].copy(), cut[1:], []
        back = self.window - self.block
        while len(pos):
            step = self.shift[self._slot(view[pos + back] & self.mask)]
            zero = step == 0
            if zero.any():
                hits.append(pos[zero])
                step[zero] = 1
            pos += step
            alive = pos < end
            if not alive.all():
                pos, end = pos[alive], end[alive]
        if not hits:
            return
        at = np.concatenate(hits)
        first, last = view[at] & self.mask, view[at + back] & self.mask
        pair = first ^ (last * _ODD)
        slot = np.minimum(np.searchsorted(self.ends, pair), len(self.ends) - 1)
        keep = self.ends[slot] == pair
        for p, a, b in zip(at[keep].tolist(), first[keep].tolist(), last[keep].tolist(), strict=True):
            for i in self.buckets.get((a, b), ()):
                if raw.startswith(self.patterns[i], p):
                    found.append((p, self.ids[i]))


def _words(data: np.ndarray) -> np.ndarray:
    """Little-endian 8-byte word at every byte offset, without copying."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


class WuManber:
    """``search(text)`` lists ``(start, pattern number)`` of every occurrence of every pattern."""

    def __init__(self, patterns: list[bytes]):
        groups: dict[bool, list[int]] = {}
        for i, p in enumerate(patterns):
            if p:
                groups.setdefault(len(p) < SHORT, []).append(i)
        self.machines = [_Machine([patterns[i] for i in ids], ids) for ids in groups.values()]

    def search(self, raw: bytes) -> list[tuple[int, int]]:
        found: list[tuple[int, int]] = []
        view = _words(np.frombuffer(raw + b"\0" * 8, np.uint8))
        for m in self.machines:
            m.search(raw, view, len(raw), found)
        return found
