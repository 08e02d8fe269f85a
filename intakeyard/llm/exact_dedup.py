"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

1. One scan turns each text into its digest (SHA-256 of the text without ASCII white
   space); only ``(row, id, length, digest)`` goes on, written once as a checkpoint.
2. A Misra-Gries summary (Spark's mergeable frequent-items sketch, a Misra-Gries variant
   with a fixed number of counters) names the digests that may be frequent. Only the top ``heavy``
   of its counters are named, so only a digest above about ``1 / heavy`` of the rows is sure to be
   among them; smaller groups may go the ordinary way, and the largest of these grows with the table.
3. The named digests are counted exactly and their winners found; only these verified rows
   (at most ``heavy`` of them: a proven bound) are broadcast, and rows that carry one of
   them are decided map-side, so no shuffle ever sees a hot digest.
4. The other digests, none of them above about ``1 / heavy`` of the rows, are decided by one ordinary shuffle on the digest.

Defined results: a null text counts as empty; empty and all-white texts form one group like
any other; ties in length go to the smallest id (null ids last), and among repeated rows with the same id
exactly one is kept; an empty table gives an empty result. Other columns of the input are
never read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import saved

#: ASCII white space: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, id, n, digest)``: one row per document; ``n`` is the code point count of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.length(text).alias("n"), F.unhex(F.sha2(F.translate(text, WHITE, ""), 256)).alias("digest"))


def heavy_winners(rows: DataFrame, heavy: int, counters: int) -> DataFrame:
    """Verified winners of the digests a Misra-Gries summary names: at most ``heavy`` rows."""
    named = (rows.agg(F.expr(f"approx_top_k(base64(digest), {heavy}, {counters})").alias("top"))
             .select(F.explode("top").alias("t")).where("t.count > 1")
             .select(F.expr("unbase64(t.item)").alias("digest")))
    return (rows.join(F.broadcast(named), "digest", "left_semi")
            .groupBy("digest").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("group_size"))
            .where("group_size > 1"))


def _rank():
    return F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"),
                    F.col("row").alias("row"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, heavy: int = 512,
                counters: int = 16384) -> DataFrame:
    """``(id_col, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``."""
    rows = saved(digests(docs, id_col, text_col))
    winners = saved(heavy_winners(rows, heavy, counters))
    flagged = rows.join(F.broadcast(winners), "digest", "left")
    hot = flagged.where(F.col("best").isNotNull())
    group = Window.partitionBy("digest")
    rest = (flagged.where(F.col("best").isNull()).select("row", "id", "n", "digest")
            .withColumn("best", F.min(_rank()).over(group))
            .withColumn("group_size", F.count(F.lit(1)).over(group)))
    out = ["row", "id", "digest", "best", "group_size"]
    return hot.select(*out).unionByName(rest.select(*out)).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"),
        (F.col("best.row") == F.col("row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op2_exact_dedup(spark, sf_dir):
    from intakeyard.llm.common import documents

    return exact_dedup(documents(spark, sf_dir))


ORACLE = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
             CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
