"""Word shingles as 64-bit hashes: words by a keyed hash of their whole bytes, shingles by mixing the words in order."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd

from intakeyard.llm.textbytes import mix

#: A-Z to a-z; the six ASCII white characters are what ``split`` cuts at.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def digest(words: list[bytes]) -> bytes:
    """A cryptographic digest of a word sequence: equal digests mean equal sequences."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def shingle_hashes(rows: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of all texts in a row, and how many each text has.

    A text of fewer words is one shingle, a text without words has none. Words are hashed by SipHash (pandas), so
    no text can be built whose words collide by a weakness of the hash."""
    words = np.array([w for row in rows for w in row], dtype=object)
    w = pd.util.hash_array(words) if len(words) else np.empty(0, np.uint64)
    size = np.array([len(row) for row in rows], np.int64)
    first = np.cumsum(size) - size
    count = np.where(size >= width, size - width + 1, (size > 0).astype(np.int64))
    start = np.cumsum(count) - count
    at = np.repeat(first - start, count) + np.arange(count.sum())
    long = np.repeat(np.minimum(size, width), count)
    state = mix(w[at] + long.astype(np.uint64))
    for j in range(1, width):
        on = slice(None) if (long > j).all() else np.flatnonzero(long > j)
        state[on] = mix(state[on] * np.uint64(0x9E3779B97F4A7C15) + w[at[on] + j])
    return state, count
