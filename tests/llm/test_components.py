"""Connected components: against union-find, and the shuffles of a round."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from intakeyard.llm.common import FILE_CLEANUP, saved
from intakeyard.llm.components import _large_star, _small_star, components


def _roots(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_of_chains_cliques_and_random_edges(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(500 + i, 500 + j) for i in range(12) for j in range(12)]
    edges += [(1000 + rng.randrange(400), 1000 + rng.randrange(400)) for _ in range(350)] + [(3000, 3001)] * 5
    rows = [(a.to_bytes(4, "big"), b.to_bytes(4, "big")) for a, b in edges]
    got = [(int.from_bytes(r.node, "big"), int.from_bytes(r.root, "big")) for r in components(spark.createDataFrame(rows, "a binary, b binary")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == _roots(edges)


def test_a_round_takes_two_shuffles(spark):
    edges = saved(spark.range(50).select((F.col("id") + 1).alias("u"), F.col("id").alias("v")))
    plan = _small_star(_large_star(edges))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan


def test_saved_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(FILE_CLEANUP, None)
    again = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    assert saved(again).count() == 7
    assert spark.conf.get(FILE_CLEANUP, None) == before
    assert len(again.collect()) == 7
