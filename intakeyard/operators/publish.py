"""Stage, check and publish a table version without a transaction.

Data first, ledger row last: lines are parsed once, accepted rows land in a folder of their own while the
verdicts are counted on the way (an ``Observation``, no second job); uniqueness is checked and the clustered
``run_id=`` folder written from there, and its rows are counted again from storage. Only an accepted
verdict adds the ``succeeded`` ledger row, and that row is the commit. Readers
resolve the current version through the ledger, so a failed or half-written run
is invisible and the previous version stays current.

The run ledger has numbered commits (``sources.commits``). A run's ending is a compare-and-set: it is decided on a version of the
ledger and written as the next one only if no other writer came first, else decided anew. So a run ends exactly once, and a
run that another process has superseded cannot succeed. The source's listing is taken before the load; a file that
changed, came or went until the commit ends the run as ``failed``.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.operators import rules as R
from intakeyard.operators import artifacts
from intakeyard.operators.ledger import SUPERSEDED
from intakeyard.sources import files
from intakeyard.sources.commits import CommitLog

COMPANIES_SCHEMA = T.StructType(
    [T.StructField(f, T.IntegerType() if t == "int" else T.StringType(), True)
     for f, t in R.VENDOR_TYPES.items()])

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("snapshot_id", T.StringType()),
    T.StructField("target", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("finished_at", T.TimestampType()),
    T.StructField("row_count", T.LongType()), T.StructField("error", T.StringType()),
])


def _reason(violations: Column, first: Column, valid: Column, no_id: Column, no_name: Column, dups: Column) -> Column:
    """Why a load is refused (null: it is not); the first failing line comes first."""
    def counted(c: Column, what: str) -> Column:
        return F.when(c > 0, F.concat(c.cast("string"), F.lit(f" {what}")))

    return F.coalesce(
        F.when(violations > 0, F.concat(F.lit("line "), first["line_no"].cast("string"), F.lit(": "), first["rule"])),
        F.when(valid == 0, "import produced no rows"), counted(no_id, "rows without an id"),
        counted(no_name, "rows without a name"), counted(dups, "duplicate ids"))


def load_verdict(prepared: DataFrame, rules: R.RuleSet = R.VENDOR, pos_col: str = "line_no",
                 key: str = "id", name: str = "name") -> DataFrame:
    """F8/F9/D9 over one parse: accept only with no violation, at least one row, no missing key or name and
    no duplicate key. Counters are partial sums per key (lines without one are combined before the shuffle)."""
    verdict_col, m = rules.first_rule(), F.col("_m")
    ok = F.col("rule") == R.VALID
    lines = prepared.select(F.col(pos_col).alias("line_no"), verdict_col.alias("rule"),
                            F.when(verdict_col == R.VALID, R.J.as_string(R.J.field(m, key))).alias("_key"),
                            F.when(verdict_col == R.VALID, R.J.as_string(R.J.field(m, name))).alias("_name"))
    bad = ~F.col("rule").isin(R.VALID, R.BLANK_LINE)
    per_key = lines.groupBy("_key").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("rule") == R.BLANK_LINE).alias("blank_lines"),
        F.count_if(ok).alias("valid_rows"), F.count_if(bad).alias("violations"),
        F.min(F.when(bad, F.struct("line_no", "rule"))).alias("_first"),
        F.count_if(ok & (F.coalesce("_key", F.lit("")) == "")).alias("missing_ids"),
        F.count_if(ok & (F.coalesce("_name", F.lit("")) == "")).alias("missing_names"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = ("lines", "blank_lines", "valid_rows", "violations", "missing_ids", "missing_names")
    v = per_key.agg(*[total(c).alias(c) for c in counts], F.min("_first").alias("_first"),
                    total(F.when(F.col("_key").isNotNull(), F.col("lines") - 1)).alias("duplicate_ids"))
    reason = _reason(F.col("violations"), F.col("_first"), F.col("valid_rows"), F.col("missing_ids"),
                     F.col("missing_names"), F.col("duplicate_ids"))
    return v.select(*counts, F.col("_first.line_no").alias("first_violation_line"), F.col("_first.rule").alias("first_violation"),
                    "duplicate_ids", F.when(reason.isNull(), "accept").otherwise("reject").alias("verdict"), reason.alias("reason"))


def land(prepared: DataFrame, path: str, rules: R.RuleSet = R.VENDOR, pos_col: str = "line_no") -> dict:
    """The one parse of a load: accepted typed rows go to ``path``, the line counts are observed on the way."""
    obs = Observation(f"land_{uuid.uuid4().hex}")
    bad = ~F.col("_rule").isin(R.VALID, R.BLANK_LINE)
    judged = prepared.select(F.col(pos_col).alias("_line"), rules.first_rule().alias("_rule"), *rules.typed_row())
    judged = judged.observe(obs, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("_rule") == R.VALID).alias("valid"),
                            F.count_if(bad).alias("violations"),
                            F.min(F.when(bad, F.struct(F.col("_line").alias("line_no"), F.col("_rule").alias("rule")))).alias("first"))
    judged.where(F.col("_rule") == R.VALID).drop("_line", "_rule").write.mode("errorifexists").parquet(path)
    return obs.get


def staged_reason(rows: DataFrame, seen: dict) -> str | None:
    """Why the landed rows must not be published: line verdicts as observed, the rest checked on the rows."""
    per_id = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.coalesce("name", F.lit("")) == "").alias("_no_name"))
    no_id = F.coalesce("id", F.lit("")) == ""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    got = per_id.agg(total(F.when(no_id, F.col("_n"))).alias("no_id"), total("_no_name").alias("no_name"),
                     total(F.when(F.col("id").isNotNull(), F.col("_n") - 1)).alias("dups"))
    first = seen["first"]
    at = F.struct(F.lit(first["line_no"] if first else None).cast("bigint").alias("line_no"),
                  F.lit(first["rule"] if first else None).cast("string").alias("rule"))
    return got.select(_reason(F.lit(seen["violations"]), at, F.lit(seen["valid"]), F.col("no_id"), F.col("no_name"),
                              F.col("dups")).alias("reason")).first()["reason"]


def stage(df: DataFrame, table_root: str, run_id: str, *, cluster_by: str = "id",
          n_files: int | None = None, bloom: tuple[str, ...] = ("website", "linkedin_url")
          ) -> tuple[str, int]:
    """Write one run's rows; returns (path, rows observed during the write).

    Rows are range-partitioned and sorted on ``cluster_by`` so point lookups skip
    row groups by min/max; bloom filters cover the other lookup columns.
    """
    path = f"{table_root.rstrip('/')}/run_id={run_id}"
    obs = Observation(f"stage_{run_id.replace('-', '_')}")
    n = n_files or max(1, df.rdd.getNumPartitions())
    # Observed above the range shuffle: the bound-sampling job must not count rows too.
    w = (df.repartitionByRange(n, cluster_by).sortWithinPartitions(cluster_by)
         .observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists"))
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
    return path, int(obs.get["rows"])


def runs_log(spark: SparkSession, ledger_path: str) -> CommitLog:
    return CommitLog(spark, ledger_path, {"": RUNS_SCHEMA})


def _run_row(spark: SparkSession, row: dict) -> dict[str, DataFrame]:
    return {"": spark.createDataFrame([tuple(row.get(f.name) for f in RUNS_SCHEMA.fields)], RUNS_SCHEMA).coalesce(1)}


def append_run(spark: SparkSession, ledger_path: str, row: dict) -> None:
    """Add one ledger row, whatever else is there."""
    runs_log(spark, ledger_path).update(lambda seen: _run_row(spark, row))


def start_run(spark: SparkSession, ledger_path: str, row: dict) -> None:
    """D3: one commit that gives the stale runs of the row's target their ``failed`` row and adds the new ``running`` one."""
    log = runs_log(spark, ledger_path)

    def rows(seen: int) -> dict[str, DataFrame]:
        runs = log.read(upto=seen).where(F.col("target") == row["target"])
        open_runs = runs.groupBy("run_id").agg(F.count_if(F.col("status") != "running").alias("_ended"), F.min("snapshot_id").alias("snapshot_id"),
                                               F.min("started_at").alias("started_at")).where("_ended = 0")
        stale = open_runs.select("run_id", "snapshot_id", F.lit(row["target"]).alias("target"), F.lit("failed").alias("status"), "started_at",
                                 F.current_timestamp().alias("finished_at"), F.lit(None).cast("bigint").alias("row_count"),
                                 F.lit(SUPERSEDED).alias("error"))
        return {"": stale.unionByName(_run_row(spark, row)[""]).coalesce(1)}

    log.update(rows)


def end_run(spark: SparkSession, ledger_path: str, row: dict) -> bool:
    """The guarded transition ``running -> succeeded | failed``; false if the run is not running (any more)."""
    log = runs_log(spark, ledger_path)

    def rows(seen: int) -> dict[str, DataFrame] | None:
        got = log.read(upto=seen).where(F.col("run_id") == row["run_id"]).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "running").alias("ended")).first()
        return _run_row(spark, row) if got["n"] > 0 and got["ended"] == 0 else None

    return log.update(rows) is not None


def publish(spark: SparkSession, prepared: DataFrame, table_root: str, ledger_path: str, *, target: str, snapshot_id: str,
            source: str | None = None) -> dict:
    """Land, check, cluster, count again, then commit through the ledger; lines are parsed once.

    Stale runs of the target are superseded and a ``running`` row comes first; the run ends in one ``succeeded``
    or ``failed`` row, written only while it is still running. An error leaves a ``failed`` row with its tail and
    is raised again; its folders stay unreferenced. A published version with other columns refuses the load. ``source``, the
    file or folder that ``prepared`` reads, must be the same before the load and at the commit (D8).
    """
    run_id = str(uuid.uuid4())
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    run = dict(run_id=run_id, snapshot_id=snapshot_id, target=target, started_at=started)

    def end(status: str, **more) -> bool:
        return end_run(spark, ledger_path, dict(run, status=status, finished_at=datetime.now(timezone.utc).replace(tzinfo=None), **more))

    before = _identity(spark, source)
    start_run(spark, ledger_path, dict(run, status="running"))
    landed = f"{table_root.rstrip('/')}/_landing/run_id={run_id}"
    try:
        reason, observed, stored = _target_reason(spark, table_root, ledger_path, target), 0, 0
        if reason is None:
            seen = land(prepared, landed)
            rows = spark.read.schema(COMPANIES_SCHEMA).parquet(landed)
            reason = staged_reason(rows, seen)
        if reason is None:
            path, observed = stage(rows, table_root, run_id)
            stored = spark.read.schema(COMPANIES_SCHEMA).parquet(path).count()
            if not stored == observed == seen["valid"]:
                reason = f"wrote {observed} of {seen['valid']} rows but storage holds {stored}"
        if reason is None:
            reason = _drifted(spark, source, before)
    except Exception as e:
        end("failed", error=f"{type(e).__name__}: {e}"[-8000:])
        raise
    finally:
        files.remove(spark, landed)
    if reason is not None:
        end("failed", error=str(reason)[-8000:])
    elif not end("succeeded", row_count=stored):
        reason = SUPERSEDED
    return dict(run_id=run_id, status="succeeded" if reason is None else "failed", rows_observed=observed, rows_stored=stored, reason=reason)


_LISTED = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modification_time", T.TimestampType())])


def _identity(spark: SparkSession, source: str | None) -> DataFrame | None:
    """The source's listing as it is now, written down (one row per file) so that it stays as it was."""
    if source is None:
        return None
    path = f"{files.scratch_root(spark)}/listings/{uuid.uuid4().hex}"
    artifacts.listing(spark, source).write.parquet(path)
    return spark.read.schema(_LISTED).parquet(path)


def _drifted(spark: SparkSession, source: str | None, before: DataFrame | None) -> str | None:
    if before is None:
        return None
    changed = artifacts.drift(before, artifacts.listing(spark, source)).where("changed")
    first = changed.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).first()
    return None if first["n"] == 0 else f"source changed during the load: {first['n']} files, first {first['path']}"


def _target_reason(spark: SparkSession, table_root: str, ledger_path: str, target: str) -> str | None:
    """The published version must have the declared columns, in order and by type."""
    path = current_path(spark, table_root, ledger_path, target)
    if path is None:
        return None
    have, want = ([(f.name, f.dataType.simpleString(), f.nullable) for f in t] for t in (spark.read.parquet(path).schema, COMPANIES_SCHEMA))
    return None if have == want else f"target columns {have} differ from {want}"


def current_path(spark: SparkSession, table_root: str, ledger_path: str, target: str) -> str | None:
    """The folder of the latest succeeded run of ``target`` (None before the first)."""
    runs = runs_log(spark, ledger_path).read()
    best = (runs.filter((F.col("status") == "succeeded") & (F.col("target") == target))
            .agg(F.max_by("run_id", F.struct("finished_at", "run_id")).alias("r")).first())
    return None if best is None or best["r"] is None else f"{table_root.rstrip('/')}/run_id={best['r']}"


def orphan_stages(staged_runs: DataFrame, ledger_runs: DataFrame) -> DataFrame:
    """K3: staged run folders that no succeeded ledger row references."""
    ok = ledger_runs.filter(F.col("status") == "succeeded").select("run_id")
    return staged_runs.join(ok, "run_id", "left_anti")


def orphan_folders(spark: SparkSession, table_root: str, ledger_path: str) -> DataFrame:
    """K3 on storage: ``(run_id)`` of run folders that hold files and that no succeeded run references."""
    held = files.listing(spark, table_root, "*.parquet").select(F.regexp_extract("path", "/run_id=([^/]+)/", 1).alias("run_id")).distinct()
    return orphan_stages(held, runs_log(spark, ledger_path).read())
