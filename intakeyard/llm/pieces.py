"""Token ids of text pieces, looked up instead of encoded again; memory bounded by pieces and their length."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Longer pieces are encoded each time they come and never kept.
LONGEST = 64


class PieceIds:
    """``encode`` gives the ids of a list of pieces; about ``entries`` pieces of ``longest`` characters at most stay in memory.

    When there are more, those that came again since the last time stay, unless they fill half the room by themselves."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: int, longest: int = LONGEST):
        self.encode, self.entries, self.longest = encode, entries, longest
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.kept = pa.array([], pa.large_list(pa.int32()))
        self.again = np.zeros(0, bool)

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and how many each piece has."""
        if len(self.code) > self.entries:
            self._thin()
        code, ids, known = self.code, self.kept, len(self.code)
        new, long = set(pieces).difference(code), []
        if new:
            long = [p for p in new if len(p) > self.longest]
            short = list(new.difference(long))
            code.update(zip(short + long, range(known, known + len(new)), strict=True))
            ids = pa.concat_arrays([ids, *self._ids(short), *self._ids(long)])
            self.kept = ids.slice(0, known + len(short))
            self.again = np.concatenate([self.again, np.zeros(len(short), bool)])
        at = np.fromiter(map(code.__getitem__, pieces), np.int64, len(pieces))
        for p in long:
            del code[p]
        self.again[at[at < known]] = True
        lists = ids.take(pa.array(at))
        return np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets))

    def _thin(self) -> None:
        stay = np.flatnonzero(self.again)
        if len(stay) > self.entries // 2:
            return self.forget()
        place = dict(zip(stay.tolist(), range(len(stay)), strict=True))
        self.code = {p: place[i] for p, i in self.code.items() if i in place}
        self.kept = self.kept.take(pa.array(stay))
        self.again = np.zeros(len(stay), bool)

    def _ids(self, pieces: list[str]) -> list[pa.Array]:
        # encodings are large objects; few at a time
        return [pa.array(self.encode(pieces[at:at + 2000]), pa.large_list(pa.int32())) for at in range(0, len(pieces), 2000)]
