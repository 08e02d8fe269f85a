"""Contiguous 1-based record positions that follow file order, at any scale.

``monotonically_increasing_id`` numbers rows inside each scan partition without
gaps; a partition may hold several files or one block of a large file. The rows
of one (partition, file, block) segment are contiguous, so a tiny per-segment
count, ordered by (file, block start), gives every segment its offset. Two light
passes over the input, no shuffle of the records themselves, no single task over
the data (``row_number`` without PARTITION BY would be one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Segments are one row per (scan partition, file, block); broadcast them only while
# that bound is small, else let the join shuffle.
SEGMENT_BYTES = 96
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def segment_bound(df: DataFrame) -> int:
    return df.rdd.getNumPartitions() + len(df.inputFiles())


def with_positions(df: DataFrame, *, pos_col: str = "line_no", file_pos_col: str | None = None,
                   file_col: str | None = None) -> DataFrame:
    """Add ``pos_col`` (global, file-name order then in-file order) to a file scan.

    ``df`` must be a direct file scan (text, csv, json...) so ``_metadata`` exists.
    ``file_pos_col`` adds the position inside each file; ``file_col`` keeps the path.
    """
    bound = segment_bound(df)
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.spark_partition_id().alias("_p"),
        F.monotonically_increasing_id().alias("_m"),
    )
    segments = tagged.groupBy("_p", "_f", "_b").agg(
        F.min("_m").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ordered = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_file = Window.partitionBy("_f").orderBy("_b").rowsBetween(Window.unboundedPreceding,
                                                                   Window.currentRow)
    segments = segments.select(
        "_p", "_f", "_b", "_first",
        (F.sum("_n").over(ordered) - F.col("_n")).alias("_off"),
        (F.sum("_n").over(per_file) - F.col("_n")).alias("_foff"),
    )
    if bound * SEGMENT_BYTES <= BROADCAST_LIMIT_BYTES:
        segments = F.broadcast(segments)
    joined = tagged.join(segments, ["_p", "_f", "_b"])
    in_seg = F.col("_m") - F.col("_first")
    cols = [c for c in df.columns]
    out = [(F.col("_off") + in_seg + 1).alias(pos_col)]
    if file_pos_col:
        out.append((F.col("_foff") + in_seg + 1).alias(file_pos_col))
    if file_col:
        out.append(F.col("_f").alias(file_col))
    return joined.select(*out, *cols)


def read_lines(spark: SparkSession, path: str, *, pos_col: str = "line_no",
               file_pos_col: str | None = None, file_col: str | None = None) -> DataFrame:
    """Lines of a text file or folder as ``(pos_col, value)``; blank lines are kept."""
    return with_positions(spark.read.text(path), pos_col=pos_col, file_pos_col=file_pos_col,
                          file_col=file_col)
