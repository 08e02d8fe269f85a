"""Suffix dedup: leading tokens that agree in all but the anchor's low bits, and one pass over the windows."""

from __future__ import annotations

import numpy as np

from intakeyard.llm import suffix_dedup as S


def test_anchors_that_differ_in_low_bits_only_are_told_apart_by_bytes():
    data = np.frombuffer(b"abcdefghijklmnop" + b"abcdefghijklmnoq" + b"abcdefghijklmnop", np.uint8)
    g = np.array([1 << 40, (1 << 40) + 1, 1 << 40], np.uint64)
    again, leads = S.Suffixes(g, np.zeros(3, np.uint64), np.array([0, 16, 32]), data, 16).repeated()
    assert again.tolist() == [True, False, True] and leads.tolist() == [True, True, False]


def test_windows_are_hashed_once(spark, monkeypatch):
    kept = []
    real = S.saved
    monkeypatch.setattr(S, "saved", lambda df: kept.append(df.columns) or real(df))
    docs = spark.createDataFrame([(1, "x" * 30 + "0123456789" * 5), (2, "0123456789" * 5 + "y" * 9), (3, None)], "doc_id bigint, text string")
    got = {r.id: (r.n_bytes, r.n_removed) for r in S.suffix_dedup(docs, width=40).collect()}
    assert got == {1: (80, 50), 2: (59, 50), 3: (0, 0)}
    assert ["g", "r", "k1", "k2", "pos"] in kept
