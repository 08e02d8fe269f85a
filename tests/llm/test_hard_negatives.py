"""Hard negatives against plain loops, the interval's guarantee, and the SQL on whole tables."""

import math
import random

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm import hard_negatives as H
from intakeyard.llm.common import saved

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                       T.StructField("row", T.StringType()), T.StructField("score", T.StringType())])


def brute(rows, scale=256, low=30, high=90, k=5, m=10):
    use = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab, *_ in rows
           if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []

    def first(found, n):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:n]

    for a, (i, v, lab) in enumerate(use):
        if i is None or i % 10:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), j, other) for b, (j, w, other) in enumerate(use) if b != a and len(w) == len(v)]
        for p, j, _ in first([s for s in scored if s[2] == lab], k):
            found = first([s for s in scored if s[2] != lab and low * p <= 100 * s[0] <= high * p], m)
            out += [(i, j, r + 1, n, p, s) for r, (s, n, _) in enumerate(found)]
    return out


def nasty(seed, n, dim):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = r.randrange(4)
        rows.append((i, [x + r.gauss(0, 0.6) for x in centres[c]], r.choice([c, c, c, r.randrange(4)]), "x", "y"))
    hot = rows[3][1]
    rows += [(n + k, hot, k % 3, "x", "y") for k in range(40)]  # one very common vector
    rows += [rows[0], rows[0], (None, rows[1][1], 1, "x", "y"), (None, None, 1, "x", "y"), (900, None, 1, "x", "y"), (910, rows[2][1], None, "x", "y"),
             (920, [float("nan")] * dim, 1, "x", "y"), (930, [None] * dim, 1, "x", "y"), (940, [float("inf")] + [0.0] * (dim - 1), 1, "x", "y"),
             (950, [0.0] * dim, 2, "x", "y"), (960, [1.0] * (dim + 3), 1, "x", "y"), (970, [1.0] * (dim + 3), 1, "x", "y"),
             (980, [0.9] * (dim + 3), 2, "x", "y"), (990, [], 1, "x", "y"), (1000, [], 1, "x", "y"), (1001, [], 3, "x", "y"), (1010, [1e6] * dim, 1, "x", "y")]
    return rows


def run(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return H.hard_negatives(saved(H.coded(H.usable(table, "vec_id", "embedding", "label", 256))), F.col("id") % 10 == 0).collect()


def test_against_plain_loops(spark, monkeypatch):
    for seed, dim, slot, sets in ((1, 16, 8192, 4096), (2, 7, 50, 6), (3, 1, 90, 9)):
        monkeypatch.setattr(H, "SLOT_ROWS", slot)
        monkeypatch.setattr(H, "SET_ANCHORS", sets)
        rows = nasty(seed, 240, dim)
        assert sorted(map(repr, map(tuple, run(spark, rows)))) == sorted(map(repr, brute(rows)))


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1, "", ""), (10, None, 1, "", "")]) == []


def test_whole_numbers_beyond_floats(spark):
    rows = [(10 * k, [float(2**22 + k), float(3 * k)], k % 2, "", "") for k in range(8)]
    assert sorted(map(tuple, run(spark, rows))) == sorted(brute(rows))


def test_intervals_hold():
    """Every product lies in its interval, for any shape and scale; and the intervals of long vectors do drop rows."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for dim, scale in ((1, 3), (5, 1000), (64, 200), (100, 1 << 20)):
        vec = rng.normal(0, scale, (300, dim)).astype(np.int64)
        vec[0] = 0
        words, along, rest = H.codes_of(vec.astype(np.float64))
        slot = H.Slot(pa.table({"row": np.arange(300), "id": np.arange(300), "label": np.zeros(300, np.int64), "vec": list(vec),
                                "code": [w.tobytes() for w in words], "along": along, "rest": rest}))
        true = vec[:40].astype(object) @ vec.T.astype(object)
        for s, middle, half in slot.intervals(vec[:40]):
            got = true[s:s + len(middle)].astype(np.float64)
            assert (np.abs(got - middle) <= half).all()
            assert dim == 1 or (half < np.sqrt((vec[s:s + len(middle)].astype(float)**2).sum(1)[:, None] * (vec.astype(float)**2).sum(1)) + 1).mean() > 0.9
