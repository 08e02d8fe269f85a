"""Lookup tables stay within their bound on many long texts without spaces, and results do not change."""

import random

import pytest

from intakeyard.llm import byte_bpe, token_counts
from intakeyard.llm.pieces import LONGEST, PieceIds

P = pytest.importorskip("public_tokenizers")


def long_texts(n):
    r = random.Random(n)
    return ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(600)) for _ in range(n)] + ["short words here", "short words there"] * 5


def test_long_unspaced_texts_are_not_kept():
    codec = byte_bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, 50)
    counter = token_counts.Counter(token_counts.read_pieces(P.path("piece_bpe_32k.model")), 50)
    first = None
    for _ in range(2):
        texts = long_texts(120)
        now = []
        for k in range(0, len(texts), 10):
            ids, counts = codec.encode(texts[k:k + 10])
            now += [counts.tolist(), counter.totals(texts[k:k + 10])[0]]
            assert codec.decode(ids).decode() == "".join(texts[k:k + 10])
            assert all(len(p) <= LONGEST for p in codec.pieces.code) and all(len(w) <= LONGEST for w in counter.known)
            assert len(codec.pieces.code) == len(codec.pieces.kept) <= 50 + 20 and len(counter.known) <= 50 + 20
        assert first is None or now == first
        first = now


def test_pieces_that_come_again_stay():
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return [[len(p), ord(p[0])] for p in pieces]

    ids = PieceIds(encode, 20)
    r = random.Random(1)
    for k in range(200):
        pieces = ["often", "x" * 100, f"once{k}", f"some{r.randrange(9)}", "often"]
        r.shuffle(pieces)
        flat, n = ids.of(pieces)
        assert flat.tolist() == [v for p in pieces for v in (len(p), ord(p[0]))] and n.tolist() == [2] * 5
        assert len(ids.code) == len(ids.kept) == len(ids.again) <= 24
    assert asked.count("often") == 1 and asked.count("x" * 100) == 200


def test_words_that_come_again_are_scored_once():
    counter = token_counts.Counter(token_counts.read_pieces(P.path("piece_bpe_32k.model")), 20)
    learned, learn = [], counter.learn
    counter.learn = lambda words: learned.extend(words) or learn(words)
    found = {tuple(counter.totals(["often here"])[0]) for k in range(100) if counter.totals([f"often here once{k} x\0y{k}"])}
    assert len(found) == 1 and learned.count("▁often") == learned.count("▁here") == 1
    assert len(counter.known) <= 20


def test_zero_characters_do_not_begin_words():
    counter = token_counts.Counter([("▁", -1.0), ("a", -2.0), ("aa", -2.5)], 20)
    unknown = counter.unknown
    assert counter.totals(["aa\0\0a a"]) == ([4 + 2], [-1.0 - 2.5 + 2 * unknown - 2.0 - 1.0 - 2.0])
