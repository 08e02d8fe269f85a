"""Minimal keys against all combinations tried out, and what the search may skip."""

import random
from itertools import combinations

import pytest

from intakeyard.operators import keys


def brute(rows, names, width):
    whole = [i for i in range(len(names)) if all(r[i] is not None for r in rows)]
    found = []
    for k in range(1, width + 1):
        for c in combinations(whole, k):
            if not any(set(f) <= set(c) for f in found) and len({tuple(r[i] for i in c) for r in rows}) == len(rows):
                found.append(c)
    return sorted(tuple(names[i] for i in c) for c in found) if rows else []


@pytest.mark.parametrize("evidence", [20_000, 3])
def test_against_all_combinations(spark, monkeypatch, evidence):
    monkeypatch.setattr(keys, "EVIDENCE_ROWS", evidence)
    r = random.Random(5)
    names = ["a", "b", "c", "d", "e", "x y"]
    for shape in ((4, 4, 6, 3, 2, 5), (30, 2, 30, 2, 2, 2), (3, 3, 3, 3, 3, 3)):
        seen = {tuple(r.randrange(n) for n in shape) for _ in range(60)}
        rows = [(a, str(b), float(c) * 0.5, d, None if e == 1 and shape[4] == 2 else e, f"{f},1") for a, b, c, d, e, f in seen]
        df = spark.createDataFrame(rows, "a long, b string, c double, d int, e int, `x y` string").repartition(3)
        assert sorted(keys.minimal_keys(df, 3)) == brute(rows, names, 3)


def test_no_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "a int, b string")
    assert keys.minimal_keys(twice) == []
    assert keys.minimal_keys(spark.createDataFrame([], "a int, b string")) == []
    assert keys.minimal_keys(spark.createDataFrame([(1, None), (2, None)], "a int, b string")) == [("a",)]
    assert keys.minimal_keys(spark.createDataFrame([([1],)], "a array<int>")) == []


def test_values_that_look_alike(spark):
    """Values meet by themselves, not by how they are joined: ('1', '12') is not ('11', '2'); 0.0 equals -0.0."""
    df = spark.createDataFrame([("1", "12", 0.0), ("11", "2", 0.0), ("1", "2", 1.0)], "a string, b string, c double")
    assert sorted(keys.minimal_keys(df)) == brute([("1", "12", 0.0), ("11", "2", 0.0), ("1", "2", 1.0)], "abc", 3)
    assert keys.minimal_keys(spark.createDataFrame([(0.0,), (-0.0,)], "a double")) == []


def test_search_prunes():
    s = keys.Search(4)
    s.add_agree([0b0011, 0b0001, 0b0110])
    assert sorted(s.agree) == [0b0011, 0b0110]
    assert s.open(1) == [0b1000]
    s.keys.append(0b1000)
    assert s.open(2) == [0b0101] and s.open(3) == [0b0111]


def test_key_of_two_columns(spark):
    frames = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("conversations", "lineitem")}
    found = {(r.table_name, r.key_columns) for r in keys.composite_keys(spark, frames, 2).collect()}
    assert ("conversations", "conv_id,turn") in found
    assert ("lineitem", "l_orderkey,l_linenumber") not in found  # the given rows repeat these pairs


def test_slices_refute_before_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(keys, "EVIDENCE_ROWS", 20)
    asked, refuted = [], keys._refuted
    monkeypatch.setattr(keys, "_refuted", lambda rows, names, sets, pivots, parts: asked.append((parts, list(sets))) or refuted(rows, names, sets, pivots, parts))
    r = random.Random(3)  # of any two columns some rows agree, rarely enough to escape the first rows
    rows = [(r.randrange(300), r.randrange(300), r.randrange(300), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    assert sorted(keys.minimal_keys(df, 2)) == brute(rows, "abcd", 2) == [("d",)]
    assert {p for p, _ in asked} > {64, 1}
    assert [s for p, sets in asked for s in sets if p == 1] == [0b1000]


def test_unlike_values_of_one_hash(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(keys, "_hash", lambda members: F.pmod(F.xxhash64(*[F.col(f"h{n}") for n in members]), F.lit(3)))
    rows = [(i, i % 7, i // 7, i % 2) for i in range(49)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    assert sorted(keys.minimal_keys(df, 3)) == brute(rows, "abcd", 3)


@pytest.mark.parametrize("few_rows, modulus", [(1 << 20, None), (40, None), (1 << 20, 3)])
def test_large_tables_against_all_combinations(spark, monkeypatch, few_rows, modulus):
    from pyspark.sql import functions as F

    monkeypatch.setattr(keys, "EVIDENCE_ROWS", 3)
    monkeypatch.setattr(keys, "LARGE_ROWS", 1)
    monkeypatch.setattr(keys, "FEW_ROWS", few_rows)
    if modulus:
        monkeypatch.setattr(keys, "_hash", lambda members: F.pmod(F.xxhash64(*[F.col(f"h{n}") for n in members]), F.lit(modulus)))
    r = random.Random(8)
    for shape in ((40, 30, 12, 9, 7), (90, 90, 90, 2, 2)):
        rows = [(*(r.randrange(n) for n in shape[:-1]), str(r.randrange(shape[-1]))) for _ in range(300)]
        df = spark.createDataFrame(rows, "a int, b int, c int, d int, e string").repartition(3)
        assert sorted(keys.minimal_keys(df, 3)) == brute(rows, "abcde", 3)


def test_rows_that_share_a_part_decide(spark, monkeypatch):
    """A few rows agree on two columns; what contains these is never asked of the whole table."""
    monkeypatch.setattr(keys, "EVIDENCE_ROWS", 20)
    monkeypatch.setattr(keys, "LARGE_ROWS", 1000, raising=False)
    asked, refuted = [], keys._refuted
    monkeypatch.setattr(keys, "_refuted", lambda rows, names, sets, pivots, parts:
                        asked.append((getattr(rows, "df", rows).count(), parts, list(sets))) or refuted(rows, names, sets, pivots, parts))
    r = random.Random(4)
    rows = [(r.randrange(300), r.randrange(3000), r.randrange(50), r.randrange(1000), r.randrange(400)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    found = sorted(keys.minimal_keys(df, 3))
    assert found == brute(rows, "abcde", 3) and ("a", "b", "d") in found
    assert [m for n, parts, sets in asked for m in sets if n == 6000 and parts == 1 and m & 0b11 == 0b11 and m.bit_count() == 3] == []


def test_a_hot_value_far_from_the_first_rows_is_met_first(spark, monkeypatch):
    """Hashes are counted behind the shuffle only, so no column with a hot value may come that far."""
    monkeypatch.setattr(keys, "EVIDENCE_ROWS", 200)
    asked, refuted = [], keys._refuted
    monkeypatch.setattr(keys, "_refuted", lambda rows, names, sets, pivots, parts: asked.extend(sets) or refuted(rows, names, sets, pivots, parts))
    df = spark.range(4000).selectExpr("CASE WHEN id < 2000 THEN id ELSE -1 END AS a", "id AS b")
    assert keys.minimal_keys(df, 2) == [("b",)] and set(asked) == {0b10}


def test_a_hash_is_counted_once_and_behind_the_shuffle(spark):
    rows = keys.hashed(spark.range(1000).selectExpr("id AS c0", "id % 7 AS c1"), ["c0", "c1"], 1000)
    met = keys._met(rows, ["c0", "c1"], [0b01, 0b10, 0b11], {0b01: "c0", 0b10: "c1", 0b11: "c0"}, 1)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("HashAggregate") < plan.index("Exchange")
    assert sorted(r.c for r in met.collect()) == [1] * 2000 + [142] + [143] * 6
