"""Write-once objects and the manifest document of a snapshot.

``store`` copies planned source files to object keys under a root. An object is created only if its key is free, is then read back
and hashed, and is never replaced: ``written``, ``reused`` (the same bytes are there), ``collision`` (other bytes are there) or
``changed`` (the source no longer is what was planned). Files are streamed in chunks by one task each, so a lost task is simply
run again: what it had finished is reused.

``manifest`` is a document of one JSON line per file, in order, as ordered files, with a tree of digests over it: lines are hashed
by ranges of ``FAN`` consecutive lines, then the digests by ranges of ``FAN``, up to one root. The tree depends on the lines
and their order only, not on files or partitions, and no task holds more than ``FAN`` digests.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.operators import artifacts
from intakeyard.session import ship_package
from intakeyard.sources import files, positions

#: Lines or digests under one digest.
FAN = 64


def _opened(path: str):
    """``(file system, path in it)`` of a Hadoop path."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(artifacts.arrow_uri(path))


def _hash(fs, path: str) -> tuple[int, str]:
    digest, size = hashlib.sha256(), 0
    with fs.open_input_stream(path) as src:
        while chunk := src.read(artifacts.CHUNK):
            digest.update(chunk)
            size += len(chunk)
    return size, digest.hexdigest()


def _create(fs, staged: str, target: str) -> bool:
    """Give the staged file its name if that is free; one step where the file system is local, else a check before the move."""
    import pyarrow.fs as pafs

    if isinstance(fs, pafs.LocalFileSystem):
        try:
            os.link(staged, target)  # fails if the name is taken
        except FileExistsError:
            return False
        finally:
            os.unlink(staged)
        return True
    if fs.get_file_info(target).type != pafs.FileType.NotFound:
        fs.delete_file(staged)
        return False
    fs.move(staged, target)
    return True


def _store_one(source: str, target: str, length: int, sha256: str) -> str:
    import pyarrow.fs as pafs

    fs, place = _opened(target)
    if fs.get_file_info(place).type == pafs.FileType.NotFound:
        from_fs, path = _opened(source)
        folder = place.rsplit("/", 1)[0]
        fs.create_dir(folder, recursive=True)
        staged = f"{folder}/_staged-{uuid.uuid4().hex}"
        digest, size = hashlib.sha256(), 0
        with from_fs.open_input_stream(path) as src, fs.open_output_stream(staged) as out:
            while chunk := src.read(artifacts.CHUNK):
                digest.update(chunk)
                size += len(chunk)
                out.write(chunk)
        if (size, digest.hexdigest()) != (length, sha256):
            fs.delete_file(staged)
            return "changed"
        if _create(fs, staged, place):
            return "written" if _hash(fs, place) == (length, sha256) else "collision"
    return "reused" if _hash(fs, place) == (length, sha256) else "collision"


def store(plan: DataFrame, root: str) -> DataFrame:
    """``(object_key, length, sha256, action)`` for a plan ``(path, object_key, length, sha256)``; written when evaluated.

    Two planned files with one key meet like any others: one is written, the other reused or a collision."""
    spark = plan.sparkSession
    ship_package(spark)
    base = root.rstrip("/")

    def run(batches):
        for pdf in batches:
            done = [_store_one(p, f"{base}/{k}", int(n), h) for p, k, n, h in zip(pdf["path"], pdf["object_key"], pdf["length"], pdf["sha256"], strict=True)]
            yield pd.DataFrame({"object_key": pdf["object_key"], "length": pdf["length"], "sha256": pdf["sha256"], "action": done})

    tasks = max(1, min(plan.count(), artifacts.MAX_TASKS))
    return (plan.select("path", "object_key", "length", "sha256").repartition(tasks)
            .mapInPandas(run, "object_key string, length bigint, sha256 string, action string"))


def archive(spark: SparkSession, source: str, root: str, prefix: str, glob: str = "*") -> tuple[DataFrame, str]:
    """Store every file of ``source`` under ``prefix`` and write down what became of each, then the manifest: ``(results, its folder)``.

    An error, and no manifest, if a file changed or a key holds other bytes."""
    plan = artifacts.fingerprints(spark, source, glob).withColumn("object_key", F.concat_ws("/", F.lit(prefix), F.element_at(F.split("path", "/"), -1)))
    path = f"{files.scratch_root(spark)}/archives/{files.fresh_name()}"
    store(plan, root).write.parquet(path)
    out = spark.read.parquet(path)
    bad = out.where("action IN ('changed', 'collision')").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("object_key", "action")).alias("first")).first()
    if bad["n"]:
        raise RuntimeError(f"{bad['n']} objects not stored, first {bad['first']['object_key']}: {bad['first']['action']}")
    line = F.to_json(F.struct(F.col("length").alias("bytes"), "object_key", "sha256"), {"ignoreNullFields": "false"})
    return out, write_document(spark, out.select(F.col("object_key").alias("at"), line.alias("line")), f"{root.rstrip('/')}/{prefix}/_manifest")


def write_document(spark: SparkSession, lines: DataFrame, path: str) -> str:
    """Write ``(at, line)`` as text files in order of ``at``, once; a document that is there is kept. Lines hold no line ends."""
    return files.write_lines(spark, lines, path, order_col="at", value_col="line")


def tree(spark: SparkSession, path: str, fan: int = FAN) -> DataFrame:
    """``(level, node, digest, size)`` of a document's digests: level 0 over lines, the last level its one root.

    Nodes count from 0 and ``size`` is the number of lines below; a document without lines has no nodes."""
    lines = positions.read_lines(spark, path)
    n = lines.count()
    now = lines.select((F.col("line_no") - 1).alias("node"), F.sha2("value", 256).alias("digest"), F.lit(1).cast("bigint").alias("size"))
    out, level = [], 0
    while n > 0:
        n = -(-n // fan)
        now = (now.groupBy(F.floor(F.col("node") / fan).cast("bigint").alias("parent"))
               .agg(F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("below"), F.sum("size").alias("size"))  # ``fan`` entries
               .select(F.col("parent").alias("node"), F.sha2(F.array_join(F.transform("below", lambda x: x["digest"]), ""), 256).alias("digest"), "size"))
        out.append(now.select(F.lit(level).alias("level"), "node", "digest", "size"))
        if n == 1:
            break
        level += 1
    if not out:
        return spark.createDataFrame([], "level int, node bigint, digest string, size bigint")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def root_digest(spark: SparkSession, path: str, fan: int = FAN) -> str | None:
    found = tree(spark, path, fan).orderBy(F.desc("level")).first()
    return None if found is None else found["digest"]
