"""Artifacts: listings, content fingerprints, manifests, write-once reconciliation.

Listings read metadata only (``binaryFile`` with the content column pruned).
SHA-256 is sequential inside a file, so fingerprints run in parallel across
files; a file of any size is streamed in 1 MiB chunks.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.session import ship_package

CHUNK = 1 << 20
MAX_TASKS = 10_000  # tasks of one fingerprint job; beyond it a task hashes several files


def listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, length, modification_time)``; the content column is never read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", "length", F.col("modificationTime").alias("modification_time")))


def arrow_uri(path: str) -> str:
    """A Hadoop path as Arrow reads it: Hadoop writes ``file:/x``, ``s3a://x`` and ``/x`` for ``file:///x``, ``s3://x`` and a local path."""
    if path.startswith("/"):
        return f"file://{path}"
    scheme, _, rest = path.partition(":")
    return f"file:///{rest.lstrip('/')}" if scheme == "file" else f"s3:{rest}" if scheme == "s3a" else path


def _stream_sha256(batches):
    import pyarrow.fs as pafs

    for pdf in batches:
        out = []
        for p in pdf["path"]:
            fs, rel = pafs.FileSystem.from_uri(arrow_uri(p))
            h = hashlib.sha256()
            with fs.open_input_stream(rel) as src:
                while chunk := src.read(CHUNK):
                    h.update(chunk)
            out.append(h.hexdigest())
        yield pd.DataFrame({"path": pdf["path"], "sha256": out})


def fingerprints(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``(path, length, sha256)`` for every file under ``root``."""
    ship_package(spark)
    lst = listing(spark, root, glob)
    # an explicit number of partitions: adaptive execution would put all paths in one task
    tasks = max(1, min(lst.count(), MAX_TASKS))
    sha = lst.select("path").repartition(tasks).mapInPandas(_stream_sha256, "path string, sha256 string")
    return lst.select("path", "length").join(sha, "path")


def reconcile(planned: DataFrame, stored: DataFrame) -> DataFrame:
    """K5 at table level: ``write`` (absent), ``reuse`` (same size and hash), ``collision``.

    Both sides: ``(object_key, length, sha256)``; stored keys are unique per object store.
    """
    s = stored.select("object_key", F.col("length").alias("s_len"), F.col("sha256").alias("s_sha"))
    j = planned.join(s, "object_key", "left")
    action = (F.when(F.col("s_len").isNull() & F.col("s_sha").isNull(), "write")
              .when(F.col("length").eqNullSafe(F.col("s_len")) & F.col("sha256").eqNullSafe(F.col("s_sha")),
                    "reuse").otherwise("collision"))
    return j.select("object_key", "length", "sha256", action.alias("action"))


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Identity ``(length, modification_time)`` at two times, null-safe; files that came or went changed too."""
    b = before.select("path", F.struct("length", "modification_time").alias("_b"))
    a = after.select("path", F.struct("length", "modification_time").alias("_a"))
    return b.join(a, "path", "full").select("path", (~F.col("_b").eqNullSafe(F.col("_a"))).alias("changed"))


def manifest_lines(files: DataFrame) -> DataFrame:
    """One JSON line per file, keys in alphabetical order."""
    doc = F.to_json(F.struct(F.col("byte_size").alias("bytes"), "filename", "format", "object_key",
                             "role", "sha256"), {"ignoreNullFields": "false"})
    return files.select("snapshot_id", "role", doc.alias("line"))


def manifest_digest(lines: DataFrame, files: DataFrame) -> DataFrame:
    """K6 re-aimed for scale: per snapshot an order-free digest over whole line hashes, file
    count and bytes; no per-snapshot list is ever collected.

    Each line's SHA-256 is cut in eight 32-bit limbs; every limb is summed by itself and
    the eight sums, the count and the bytes are hashed once more.
    """
    digest = F.sha2(F.col("line"), 256)
    limbs = [F.sum(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)")).alias(f"_{i}")
             for i in range(8)]
    d = lines.groupBy("snapshot_id").agg(*limbs)
    t = files.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n_files"),
                                         F.sum("byte_size").cast("bigint").alias("total_bytes"))
    whole = F.concat_ws(":", *[F.col(f"_{i}").cast("string") for i in range(8)], "n_files", "total_bytes")
    return t.join(d, "snapshot_id").select("snapshot_id", "n_files", "total_bytes",
                                           F.sha2(whole, 256).alias("manifest_digest"))


def plan_key_check(files: DataFrame) -> DataFrame:
    """Object keys must be distinct inside each snapshot (two-level aggregate)."""
    per_key = files.groupBy("snapshot_id", "object_key").agg(F.count(F.lit(1)).alias("_c"))
    return per_key.groupBy("snapshot_id").agg(
        F.sum("_c").cast("bigint").alias("n_files"), F.count(F.lit(1)).alias("n_distinct_keys")
    ).withColumn("keys_distinct", F.col("n_files") == F.col("n_distinct_keys"))
