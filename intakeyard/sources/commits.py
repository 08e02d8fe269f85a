"""Append-only tables with numbered commits, so that several writers cannot both win.

A commit is a folder ``commit=<number>`` that holds the rows it adds. It is written under a hidden name first and then renamed
to the next number; renaming never replaces a folder that is there, so of several writers that saw the same version exactly one
commits, and the others look at what is new and decide again. Readers see whole commits only. One commit may add rows to
several tables at once. Rows are ordinary Parquet: filters and column lists reach the scan.

The rename has to be atomic and exclusive, as it is on HDFS and on local file systems; on an object store without such a rename one
writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.sources import files


class CommitLog:
    """The tables of one folder. ``tables`` names them and their schemas; a single table may be named ``""``."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, T.StructType]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        numbers = [int(name.removeprefix("commit=")) for name in files.names(self.spark, self.root) if name.startswith("commit=")]
        return max(numbers, default=0)

    def read(self, table: str = "", upto: int | None = None) -> DataFrame:
        """Rows of a table as of commit ``upto`` (all), with the ``commit`` that added each."""
        upto = self.version() if upto is None else upto
        schema = T.StructType([*self.tables[table].fields, T.StructField("commit", T.LongType())])
        if upto == 0:
            return self.spark.createDataFrame([], schema)
        path = f"{self.root}/commit=*/{table}" if table else self.root
        return (self.spark.read.schema(schema).option("basePath", self.root).parquet(path)
                .select(*schema.fieldNames()).where(F.col("commit") <= upto))

    def try_commit(self, rows: dict[str, DataFrame], seen: int) -> bool:
        """Add ``rows`` as the commit after version ``seen``; false, and nothing added, if another came first."""
        staged = f"{self.root}/_staged-{uuid.uuid4().hex}"

        def write(table: str) -> None:
            schema = self.tables[table]
            rows[table].select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.parquet(f"{staged}/{table}" if table else staged)

        with ThreadPoolExecutor(max_workers=len(rows)) as pool:
            list(pool.map(write, rows))
        if files.move_new(self.spark, staged, f"{self.root}/commit={seen + 1:012d}"):
            return True
        files.remove(self.spark, staged)
        return False

    def update(self, build: Callable[[int], dict[str, DataFrame] | None]) -> int | None:
        """Commit what ``build(version)`` returns; it is asked again whenever another writer came first.

        ``None`` means there is nothing to add. Returns the number of the commit, or ``None``."""
        while True:
            seen = self.version()
            rows = build(seen)
            if rows is None:
                return None
            if self.try_commit(rows, seen):
                return seen + 1
