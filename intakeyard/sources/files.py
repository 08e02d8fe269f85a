"""Files in the shared scratch folder, and file listings.

Stand-in files are written once per input folder into the folder named by
``spark.checkpoint.dir`` and reused; writes go to a fresh folder first and are
renamed into place, so a lost executor or a second caller never sees half a file.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.session import scratch_root, ship_package


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def fresh_name() -> str:
    return uuid.uuid4().hex


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def sizes(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of a file, or of a folder's data files in name order."""
    fs, hpath = _fs(spark, path)
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(hpath) if s.isFile()]
    return sorted((p, n) for p, n in found if not p.rsplit("/", 1)[1].startswith(("_", ".")))


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder that holds files unless the target is there already (false then); check and rename are one step."""
    jvm = spark.sparkContext._jvm
    fs, dst = _fs(spark, target)
    src = jvm.org.apache.hadoop.fs.Path(source)
    try:
        if fs.getUri().getScheme() == "file":  # the system call: it does not replace a folder that holds files
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.CopyOption, 1)
            options[0] = jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (src, dst)]
            jvm.java.nio.file.Files.move(*local, options)
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(src, dst, options)
    except Exception:
        if exists(spark, target) and exists(spark, source):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making, if it is there."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


# Bump when a file-writing rule changes; the stand-in SQL is part of the key too, so a
# changed definition never reuses files written by an older one.
FIXTURE_VERSION = "4"


def fixture_dir(spark: SparkSession, sf_dir: str, name: str) -> str:
    from intakeyard.sources import standins

    key = "\n".join([FIXTURE_VERSION, sf_dir.rstrip("/"), *(sql for sql, _ in standins.STANDINS.values())])
    tag = hashlib.sha256(key.encode()).hexdigest()[:12]
    return f"{scratch_root(spark)}/intakeyard-fixtures/{tag}/{name}"


def write_once(spark: SparkSession, df: DataFrame, path: str, writer) -> str:
    """Write ``df`` with ``writer(df, tmp_path)`` unless ``path`` is already complete."""
    if exists(spark, f"{path}/_SUCCESS"):
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    writer(df, tmp)
    fs, hsrc = _fs(spark, tmp)
    _, hdst = _fs(spark, path)
    if exists(spark, f"{path}/_SUCCESS"):  # another writer was first: its files are the same
        fs.delete(hsrc, True)
        return path
    if fs.exists(hdst):
        fs.delete(hdst, True)
    fs.rename(hsrc, hdst)
    return path


def write_lines(spark: SparkSession, df: DataFrame, path: str, *, order_col: str = "line_no",
                value_col: str = "value", files: int | None = None) -> str:
    """Write one text line per row, file order = ``order_col`` order across part files.

    The number of files follows the data (Spark sizes the range partitions) unless it is given.
    """

    def _w(d: DataFrame, p: str) -> None:
        cut = (files, order_col) if files else (order_col,)
        (d.repartitionByRange(*cut).sortWithinPartitions(order_col)
           .select(value_col).write.mode("overwrite").text(p))

    return write_once(spark, df, path, _w)


#: Spark's own setting: tasks that list folders, 10,000 unless it is set, so one for nearly every folder.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Rows of a listing that go to Spark at a time.
LISTED_ROWS = 10_000
#: What Spark writes as %XX in the name of a partition's folder.
ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the system names it; none where only Spark's file systems reach it."""
    fs, hpath = _fs(spark, path)
    return hpath.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _hidden(name: str) -> bool:
    """Names that Spark's file sources leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _listed(folder: str, glob: str) -> Iterator[tuple[str, int, int | None, bool]]:
    """``(path, length, microseconds, is a folder)`` of what a folder holds; nothing if it has gone. Empty files are left out, as Spark's reader does."""
    try:
        with os.scandir(folder) as found:
            for entry in found:
                if _hidden(entry.name):
                    continue
                if entry.is_dir():
                    yield entry.path, 0, None, True
                elif fnmatchcase(entry.name, glob):
                    seen = entry.stat()
                    if seen.st_size > 0:
                        yield entry.path, seen.st_size, seen.st_mtime_ns // 1_000_000 * 1000, False
    except FileNotFoundError:
        return


def _local_listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """The folders of a level are dealt to many tasks; what they hold is written down, and the folders among it are the next level."""
    import pyarrow as pa

    ship_package(spark)
    kinds = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modification_time", pa.timestamp("us", tz="UTC")), ("folder", pa.bool_())])

    def run(batches):
        found = (row for batch in batches for folder in batch.column(0).to_pylist() for row in _listed(folder, glob))
        while rows := list(islice(found, LISTED_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, kind.type) for c, kind in zip(zip(*rows), kinds, strict=True)], schema=kinds)

    schema = "path string, length bigint, modification_time timestamp, folder boolean"
    out, n, tasks = f"{scratch_root(spark)}/listings/{uuid.uuid4().hex}", 1, 4 * spark.sparkContext.defaultParallelism
    folders, levels = spark.createDataFrame([(root,)], "path string"), []
    while n > 0:
        levels.append(f"{out}/{len(levels)}")
        folders.repartition(min(n, tasks), "path").mapInArrow(run, schema).write.parquet(levels[-1])
        folders = spark.read.schema(schema).parquet(levels[-1]).where("folder").select("path")
        n = folders.count()
    return (spark.read.schema(schema).parquet(*levels).where("NOT folder")
            .select(F.concat(F.lit("file:"), "path").alias("path"), "length", "modification_time"))


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File listing ``(path, length, modification_time)``; file content is pruned away. A task lists many folders.

    Files that the system reaches are listed by tasks that write down what they find, so the driver holds no file; others by Spark."""
    place = local_path(spark, path)
    if place is not None and not set(glob) & set("[]{}\\"):
        return _local_listing(spark, place, glob)
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:  # folders are listed by load()
        found = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", "true").load(path))
    finally:
        spark.conf.set(LISTING_TASKS, before)
    return found.select("path", "length", F.col("modificationTime").alias("modification_time"))


def write_folders(spark: SparkSession, df: DataFrame, path: str, key: str) -> None:
    """Parquet in a folder ``key=<value>`` a value, as ``partitionBy`` makes them, by many tasks; ``path`` is new.

    Without its native library Hadoop starts two processes for every file it makes on a local file system, which is nearly all the
    time that small folders take; there the files are made by Arrow, one a folder, put in place when whole."""
    tasks, place = 4 * spark.sparkContext.defaultParallelism, local_path(spark, path)
    if place is None:
        df.repartition(tasks, key).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(key).parquet(path)
        return
    ship_package(spark)

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        value, writer, staged, made = None, None, "", 0

        def end() -> None:
            writer.close()
            os.replace(staged, f"{os.path.dirname(staged)}/part-00000.snappy.parquet")

        for batch in batches:
            table, values = pa.Table.from_batches([batch]).drop_columns(["_folder"]), batch.column("_folder").to_pylist()
            at = 0
            for folder, group in groupby(values):
                n = sum(1 for _ in group)
                if folder != value:
                    if writer is not None:
                        end()
                    value, made = folder, made + 1
                    held = f"{place}/{key}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', folder) or '__HIVE_DEFAULT_PARTITION__'}"
                    os.makedirs(held, exist_ok=True)
                    staged = f"{held}/_staged-{uuid.uuid4().hex}"
                    writer = pq.ParquetWriter(staged, table.schema, compression="snappy")
                writer.write_table(table.slice(at, n))
                at += n
        if writer is not None:
            end()
        yield pa.RecordBatch.from_pydict({"made": pa.array([made], pa.int64())})

    named = df.withColumn("_folder", F.coalesce(F.col(key).cast("string"), F.lit(""))).drop(key)  # one task a folder: null and "" share one
    os.makedirs(place, exist_ok=True)
    named.repartition(tasks, "_folder").sortWithinPartitions("_folder").mapInArrow(run, "made bigint").agg(F.sum("made")).collect()
