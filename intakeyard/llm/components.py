"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one shuffle by node and a windowed minimum, a round two shuffles; edge tables are written to the shared folder
between rounds. Nothing is collected but a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import saved


def _by_node(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: different edges and the least ``v`` of each ``u``. All that goes by ``u`` shares one shuffle."""
    return edges.repartition("u").distinct().withColumn("m", F.min("v").over(Window.partitionBy("u")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to its smallest one (or to itself); edges may come several times."""
    both = _by_node(edges.union(edges.select("v", "u")))
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node; a node and its neighbours go to the smallest of these, some several times."""
    least = _by_node(edges)
    return least.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``a``, ``b``); the root is the smallest node.

    A round may leave an edge several times; one that changes nothing leaves stars, each edge once."""
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).head()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = saved(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
