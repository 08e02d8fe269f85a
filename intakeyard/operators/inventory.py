"""Inventory of the tables a session can see: columns, keys, counts, sizes, warnings.

Metadata (schemas, file listings) is one row per table or column and is built on
the driver from the catalog; anything that reads data (counts, key checks) is a
Spark job per table. Candidate keys are ruled out on proof only (a null, or a value met twice in a
bounded number of rows); the columns left pay for one exact shuffle. Keys of several columns are in ``operators.keys``.
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_SCHEMA = "table_name string, position int, column_name string, data_type string, nullable boolean"
PROOF_ROWS = 20_000  # rows in which a repeated value is looked for before the full check
EMPTY_BUT_LARGE_BYTES = 100 * 1024 * 1024
SCREEN_THREADS = 4
COUNT_THREADS = 16  # tables counted at a time; their tasks share the cluster
ATOMIC = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DateType,
          T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType, T.DoubleType,
          T.FloatType)


def columns(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, position, column_name, data_type, nullable)``."""
    rows = [(t, i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for t, df in frames.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def relations(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One row per relation with its column count."""
    return spark.createDataFrame([(t, len(df.columns)) for t, df in frames.items()],
                                 "table_name string, n_columns int")


def exact_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """A1: ``count(*)`` per table, one lazy union (Parquet answers from footers)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("exact_rows")).select(F.lit(t).alias("table_name"), "exact_rows")
        for t, df in frames.items()])


def bounded_counts(spark: SparkSession, frames: dict[str, DataFrame], timeout_s: float, threads: int = COUNT_THREADS) -> DataFrame:
    """Exact count per table under a time bound, or the reason why there is none; one failure leaves the others alone.

    Tables are counted at the same time, each job under a tag of its own that a timer of its own cancels, so all of it takes about
    as long as the slowest table (or its bound). The bound runs from the moment a count is started."""
    sc = spark.sparkContext

    def count(item: tuple[str, DataFrame]) -> tuple[str, int | None, str | None]:
        name, df = item
        tag, late, over = f"intakeyard-count-{uuid.uuid4().hex}", threading.Event(), threading.Event()

        def stop() -> None:
            late.set()
            while not over.is_set():  # again, as a job may only be submitted after this
                sc.cancelJobsWithTag(tag)
                over.wait(0.2)

        timer = threading.Timer(timeout_s, stop)
        sc.addJobTag(tag)
        timer.start()
        try:
            return name, df.count(), None
        except Exception as e:  # noqa: BLE001 - a cancelled job surfaces as a Spark error
            return name, None, f"timed out after {timeout_s:g} seconds" if late.is_set() else f"failed: {type(e).__name__}: {str(e)[:2000]}"
        finally:
            over.set()
            timer.cancel()
            sc.removeJobTag(tag)

    if timeout_s <= 0:
        raise ValueError("the time bound must be above zero")
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(frames)))) as pool:
        rows = list(pool.map(count, frames.items()))
    return spark.createDataFrame(rows, "table_name string, exact_rows bigint, count_error string")


def candidate_keys(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """S11/A8 re-aimed: single columns that are non-null and unique, checked exactly.

    Pass 1 per table: exact row and null counts, and exact distinct counts over a bounded number of
    rows. A column is ruled out only on proof: a null, or a value met twice. Pass 2 per
    table, one shuffle for all columns left: ``(column, hash of the value)``
    pairs grouped with partial aggregation; any count > 1 disqualifies. Returns a
    lazy union of the pass-2 checks.
    """
    def screen(item):
        t, df = item
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, ATOMIC)]
        if not cols:
            return t, cols, None
        whole = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"nn_{i}") for i, c in enumerate(cols)]).first()
        few = df.select(*cols).limit(PROOF_ROWS).agg(
            F.count(F.lit(1)).alias("_n"), *[F.size(F.collect_set(F.xxhash64(c))).alias(f"d_{i}") for i, c in enumerate(cols)]).first()
        return t, cols, (whole, few)

    # The per-table screening scans are independent jobs: submit them together.
    with ThreadPoolExecutor(max_workers=SCREEN_THREADS) as pool:
        screened = list(pool.map(screen, frames.items()))
    checks = []
    for t, cols, stats in screened:
        if stats is None:
            continue
        df = frames[t]
        whole, few = stats
        n = whole["_n"]
        # a hash collision could only hide a true key among PROOF_ROWS rows; one is allowed for
        survivors = [c for i, c in enumerate(cols)
                     if n > 0 and whole[f"nn_{i}"] == n and few[f"d_{i}"] >= few["_n"] - 1]
        if not survivors:
            continue
        # One shuffle for all survivors of this table: (column, value) pairs, counted.
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

        def as_text(c: str):
            v = F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if c in floats else F.col(c)
            return F.unhex(F.sha2(v.cast("string"), 256)) if c in texts else v.cast("string")

        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), as_text(c).cast("binary").alias("v")) for c in survivors
        ])).alias("p")).select("p.column_name", "p.v")
        worst = (pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_c"))
                 .groupBy("column_name").agg(F.max("_c").alias("_max")))
        checks.append(worst.filter(F.col("_max") <= 1)
                      .select(F.lit(t).alias("table_name"), "column_name"))
    if not checks:
        return spark.createDataFrame([], "table_name string, column_name string")
    return reduce(DataFrame.unionByName, checks)


def sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files and bytes per table from a distributed listing (content never read)."""
    parts = []
    for t, p in paths.items():
        lst = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
               .select("length"))
        parts.append(lst.agg(F.count(F.lit(1)).alias("n_files"),
                             F.sum("length").cast("bigint").alias("total_bytes"))
                     .select(F.lit(t).alias("table_name"), "n_files", "total_bytes"))
    return reduce(DataFrame.unionByName, parts)


def estimates(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Optimizer statistics; row count is unknown (NULL) until analysed."""
    rows = []
    for t, df in frames.items():
        st = df._jdf.queryExecution().optimizedPlan().stats()
        rc = st.rowCount()
        rows.append((t, int(str(rc.get())) if rc.isDefined() else None,
                     int(str(st.sizeInBytes()))))
    return spark.createDataFrame(rows, "table_name string, estimated_rows bigint, size_bytes bigint")


def empty_but_large(counts: DataFrame, size_df: DataFrame, threshold: int = EMPTY_BUT_LARGE_BYTES
                    ) -> DataFrame:
    """tables whose exact count is 0 but still occupy ``threshold`` bytes or more."""
    j = counts.join(size_df, "table_name")
    return j.select("table_name", "exact_rows", "total_bytes",
                    ((F.col("exact_rows") == 0) & (F.col("total_bytes") >= threshold)).alias("warning"))


def nested(cols: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per table with its ordered columns and its candidate keys."""
    per_table = cols.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct("position", "column_name", "data_type"))).alias("cols"))
    k = keys.groupBy("table_name").agg(F.array_sort(F.collect_list("column_name")).alias("keys"))
    j = per_table.join(k, "table_name", "left")
    return j.select("table_name", F.size("cols").alias("n_columns"),
                    F.array_join(F.transform("cols", lambda c: F.concat(c["column_name"], F.lit(":"),
                                                                       c["data_type"])), ",").alias("columns"),
                    F.array_join(F.coalesce(F.col("keys"), F.array().cast("array<string>")), ",")
                    .alias("candidate_keys"))
