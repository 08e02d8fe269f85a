"""Provenance ledger as tables: preflight, registration, run lifecycle, lineage.

Stored ledger rows are summarised per match key before any join (one row per
sha256, per object key, per (snapshot, role)), so a requested file meets at most
one row per key: a hash shared by a third of all files cannot fan out into pairs,
and a hot key on the requested side is split by AQE's skew-join handling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_FIELDS = ("snapshot_id", "role", "filename", "object_key", "format", "sha256", "byte_size")

SNAPSHOT_FIELDS = ("source", "dataset", "acquired_at", "manifest_key", "source_url", "description")

# Run states and the message written on superseded runs.
RUN_STATES = ("running", "succeeded", "failed")
SUPERSEDED = "Superseded after a prior importer process ended"
ERROR_TAIL_CHARS = 8000


def fingerprint(fields: tuple[str, ...] = FILE_FIELDS) -> Column:
    """Null-safe digest of a ledger row's fields (equal digests <=> equal rows)."""
    return F.sha2(F.to_json(F.struct(*[F.col(f) for f in fields]),
                            {"ignoreNullFields": "false"}), 256)


def _key_summary(stored: DataFrame, key: str, prefix: str) -> DataFrame:
    return stored.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_n"),
        F.min("_fp").alias(f"{prefix}_fp_min"), F.max("_fp").alias(f"{prefix}_fp_max"),
        F.min("snapshot_id").alias(f"{prefix}_snap_min"),
        F.max("snapshot_id").alias(f"{prefix}_snap_max"))


def match_summaries(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Requested files with what the stored ledger holds under their hash and their key."""
    s = stored.select(*FILE_FIELDS, fingerprint().alias("_fp"))
    r = requested.select("file_id", *FILE_FIELDS, fingerprint().alias("_fp"))
    by_hash = _key_summary(s, "sha256", "h")
    by_key = _key_summary(s, "object_key", "k")
    return r.join(by_hash, "sha256", "left").join(by_key, "object_key", "left")


def collisions(matched: DataFrame) -> DataFrame:
    """J6 without emitting pairs: per requested file, stored rows sharing its hash or key
    and whether any of them belongs to another snapshot."""
    other = F.lit(False)
    for p in ("h", "k"):
        other = other | F.coalesce((F.col(f"{p}_snap_min") != F.col("snapshot_id"))
                                   | (F.col(f"{p}_snap_max") != F.col("snapshot_id")), F.lit(False))
    return (matched.select(
        "file_id",
        F.coalesce(F.col("h_n"), F.lit(0)).alias("hash_matches"),
        F.coalesce(F.col("k_n"), F.lit(0)).alias("key_matches"),
        other.alias("other_snapshot"))
        .filter((F.col("hash_matches") > 0) | (F.col("key_matches") > 0)))


def reconcile(matched: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``new`` / ``verified`` / ``conflict`` / ``collision`` per requested file.

    new: nothing stored shares the hash or key; collision: something does but the
    requested snapshot is unknown; verified: every sharing row equals the request
    in all fields; conflict: otherwise.
    """
    known = snapshots.select("snapshot_id").distinct().withColumn("_known", F.lit(True))
    m = matched.join(known, "snapshot_id", "left")
    any_match = F.col("h_n").isNotNull() | F.col("k_n").isNotNull()

    def all_equal(p: str) -> Column:
        return F.col(f"{p}_n").isNull() | ((F.col(f"{p}_fp_min") == F.col("_fp"))
                                           & (F.col(f"{p}_fp_max") == F.col("_fp")))

    status = (F.when(~any_match, "new")
              .when(F.col("_known").isNull(), "collision")
              .when(all_equal("h") & all_equal("k"), "verified")
              .otherwise("conflict"))
    return m.select("file_id", status.alias("status"))


def differences(requested: DataFrame, stored: DataFrame, keys: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """Requested rows against stored ones with the same key, field by field (nulls equal nulls).

    ``(*keys, status, fields)``: ``new``, ``verified``, ``conflict`` with the differing fields in declared order, or
    ``unexpected`` for a stored row that is not requested. Of stored rows that share a key the smallest is
    compared; the uniqueness checks report such keys.
    """
    s = stored.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_s"))
    r = requested.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_r"))
    j = r.join(s, list(keys), "full")
    differ = F.array_compact(F.array(*[F.when(~F.col(f"_r.{f}").eqNullSafe(F.col(f"_s.{f}")), F.lit(f)) for f in fields]))
    status = (F.when(F.col("_s").isNull(), "new").when(F.col("_r").isNull(), "unexpected")
              .when(F.size(differ) == 0, "verified").otherwise("conflict"))
    return j.select(*keys, status.alias("status"),
                    F.when(F.col("_s").isNotNull() & F.col("_r").isNotNull(), F.array_join(differ, ",")).otherwise("").alias("fields"))


def unexpected_roles(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Roles stored for a requested snapshot that the request does not name."""
    snaps = requested.select("snapshot_id").distinct()
    in_snap = stored.join(snaps, "snapshot_id", "left_semi")
    return (in_snap.join(requested.select("snapshot_id", "role"), ["snapshot_id", "role"],
                         "left_anti").select("snapshot_id", "role"))


def register(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Insert when (snapshot, role) is absent, else verify against the stored row."""
    s = (stored.select("snapshot_id", "role", fingerprint().alias("_fp"))
         .groupBy("snapshot_id", "role")
         .agg(F.min("_fp").alias("_min"), F.max("_fp").alias("_max")))
    r = requested.select("file_id", "snapshot_id", "role", fingerprint().alias("_rfp"))
    j = r.join(s, ["snapshot_id", "role"], "left")
    action = F.when(F.col("_min").isNull(), "insert").otherwise("verify")
    same = F.when(F.col("_min").isNull(), F.lit(None).cast("boolean")).otherwise(
        (F.col("_min") == F.col("_rfp")) & (F.col("_max") == F.col("_rfp")))
    return j.select("file_id", "snapshot_id", "role", action.alias("action"),
                    same.alias("matches_stored"))


def supersede(runs: DataFrame, target: str) -> DataFrame:
    """D3: stale ``running`` runs of one target become ``failed`` with a fixed message."""
    stale = (F.col("status") == "running") & (F.col("target") == target)
    return runs.select("run_id", "target",
                       F.when(stale, "failed").otherwise(F.col("status")).alias("status"),
                       F.when(stale, SUPERSEDED).alias("error"))


def finish(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Guarded ``running -> succeeded|failed``; other states reject the request.

    ``outcomes``: ``(run_id, new_status, row_count, error)``, at most one per run.
    """
    j = runs.select("run_id", F.col("status").alias("prior_status")).join(outcomes, "run_id")
    applied = F.col("prior_status") == "running"
    return j.select(
        "run_id", "prior_status",
        F.when(applied, F.col("new_status")).otherwise(F.col("prior_status")).alias("status"),
        F.when(applied & (F.col("new_status") == "succeeded"), F.col("row_count")).alias("row_count"),
        F.when(applied & (F.col("new_status") == "failed"),
               F.expr(f"right(error, {ERROR_TAIL_CHARS})")).alias("error"),
        applied.alias("applied"))


def current_version(runs: DataFrame) -> DataFrame:
    """Per target, the latest succeeded run (ties on start time: larger run id)."""
    ok = runs.filter(F.col("status") == "succeeded")
    best = F.max_by(F.struct("run_id", "started_at", "row_count"),
                    F.struct("started_at", "run_id"))
    return ok.groupBy("target").agg(best.alias("_b")).select(
        "target", "_b.run_id", F.col("_b.started_at").cast("string").alias("started_at"),
        "_b.row_count")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
            edge: str) -> DataFrame:
    """Child rows whose (non-null) reference has no parent row."""
    keys = parent.select(F.col(parent_key).alias("_k")).distinct()
    c = child.select(F.col(child_key).alias("_k"))
    lost = c.filter(F.col("_k").isNotNull()).join(keys, "_k", "left_anti")
    n_child = c.agg(F.count(F.lit(1)).alias("child_rows"))
    n_lost = lost.agg(F.count(F.lit(1)).alias("orphan_rows"))
    return (n_child.withColumn("_one", F.lit(1)).join(n_lost.withColumn("_one", F.lit(1)), "_one")
            .select(F.lit(edge).alias("edge"), "child_rows", "orphan_rows"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
