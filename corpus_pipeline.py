"""Corpus pipeline: five stages over ``documents``, each one of the operators in ``intakeyard.llm``.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns a
DataFrame; the caller writes it as Parquet and reads it again for the next stage. All but the last return the
columns of ``documents``. Stages read only ``doc_id`` and ``text``; other columns pass through as they are, whatever their
names (a stage works on columns under names of its own), except that line dedup sets ``n_chars``, where the table has it, to the
length of the text it leaves, and that the last stage's three results replace columns of their names.

Null and empty texts are documents like any other: they are scored, have no lines, near copies, passages or tokens. Of repeated
rows one stays from the near-dedup on. Null ids stay apart from each other unless their texts are near copies, of which one
stays. Ties in a score fall on the same side of the threshold. Empty tables give empty results.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from intakeyard.llm import byte_bpe, decontaminate, line_templates, near_dedup, quality
from intakeyard.llm.common import documents, row_key
from intakeyard.session import scratch_root
from intakeyard.sources.tables import load


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns under generated names, and these names by the old ones."""
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _back(out: DataFrame, names: dict[str, str]) -> DataFrame:
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry ranking accepts (score at or above the threshold)."""
    model = quality.fit_quality(docs, load(spark, sf_dir, "labels"))
    rows, names = _apart(docs)
    return _back(quality.quality_scores(rows, model, names["text"], carry=rows.columns).where("predicted = 1"), names)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates; every document stays, if only with an empty text.

    Near copies, in the sense of the next stage, count as one text."""
    rows, names = _apart(docs)
    out = line_templates.line_dedup(rows, names["doc_id"], names["text"], carry=rows.columns, classes=near_dedup.near_classes(docs, percent=80))
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return _back(out.withColumn(names["text"], F.col("kept_text")), names)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id."""
    found = near_dedup.near_dedup(docs, percent=80)
    keep = (found.where(F.col("id").eqNullSafe(F.col("component_id"))).select("key").distinct())
    rows, names = _apart(docs)
    first = Window.partitionBy("key").orderBy("row")
    rows = rows.withColumn("key", row_key(names["doc_id"], names["text"])).join(keep.hint("shuffle_hash"), "key", "left_semi")
    return _back(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("n", F.row_number().over(first)).where("n = 1"), names)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (hit words under a twentieth of all words)."""
    rows, names = _apart(docs)
    out = decontaminate.decontaminate(rows, load(spark, sf_dir, "benchmark"), text_col=names["text"], carry=rows.columns)
    return _back(out.where("NOT contaminated"), names)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text encoded and decoded: token count and the hashes of ids and decoded bytes."""
    return byte_bpe.byte_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                             carry=docs.columns)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", bpe_stage),
]

#: The ranking model, MinHash and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage results go to the shared folder as Parquet."""
    folder = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
