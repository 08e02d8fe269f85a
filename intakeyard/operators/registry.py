"""The stored provenance ledger: snapshots and their files, registered once and verified from then on.

``register`` takes requested snapshots and files, compares them with what is stored, and adds what is new as one commit of both
tables (``sources.commits``), so a repeated registration writes nothing and two at the same time cannot both add a row.

A file is ``verified`` (stored as requested), ``conflict`` (its snapshot holds another file in that role), ``collision`` (its hash
or object key belongs to another stored file, or to a file earlier in the request by snapshot, role and content) or ``new``. A
snapshot is refused as a whole, nothing of it being added, if its stored metadata differ, if a stored role is missing from the
request, or if any of its files is a conflict or a collision; else its new files, and itself if it is not stored yet, are added.

All comparisons are equi-joins against one row per hash, key or role, so a hash that very many files share meets each file once.
Null fields equal null fields; repeated request rows count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.operators import ledger
from intakeyard.sources import files as storage
from intakeyard.sources.commits import CommitLog

SNAPSHOTS = T.StructType([T.StructField(c, T.StringType()) for c in ("snapshot_id", *ledger.SNAPSHOT_FIELDS)])
FILES = T.StructType([T.StructField("file_id", T.LongType()),
                      *[T.StructField(c, T.LongType() if c == "byte_size" else T.StringType()) for c in ledger.FILE_FIELDS]])


def registry(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, root, {"snapshots": SNAPSHOTS, "files": FILES})


def file_statuses(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """The requested files (``FILES`` columns, ``_fp``) with their ``status``."""
    held = stored.select("snapshot_id", "role", ledger.fingerprint().alias("_s")).groupBy("snapshot_id", "role").agg(F.min("_s").alias("_own"))
    hashes, names = (stored.select(c).distinct().withColumn(f"_{c}", F.lit(True)) for c in ("sha256", "object_key"))
    at = (requested.withColumn("_fp", ledger.fingerprint()).join(held, ["snapshot_id", "role"], "left")
          .join(hashes, "sha256", "left").join(names, "object_key", "left"))
    fresh = F.col("_own").isNull() & F.col("_sha256").isNull() & F.col("_object_key").isNull()
    me = F.struct("snapshot_id", "role", "_fp")
    for by in (["sha256"], ["object_key"], ["snapshot_id", "role"]):
        first = at.where(fresh).groupBy(*by).agg(F.min(me).alias(f"_first_{by[-1]}"))
        at = at.join(first, by, "left")
    earlier = F.lit(False)
    for c in ("sha256", "object_key", "role"):
        earlier = earlier | (F.col(f"_first_{c}") != me)
    status = (F.when(F.col("_own") == F.col("_fp"), "verified").when(F.col("_own").isNotNull(), "conflict")
              .when(~fresh | earlier, "collision").otherwise("new"))
    return at.select(*FILES.fieldNames(), "_fp", status.alias("status"))


def judged(snapshots: DataFrame, requested: DataFrame, stored_snapshots: DataFrame, stored: DataFrame) -> DataFrame:
    """Every requested file with its ``status`` and whether its snapshot is ``refused``."""
    wanted = snapshots.select("snapshot_id").distinct()
    metadata = ledger.differences(snapshots, stored_snapshots.join(wanted, "snapshot_id", "left_semi"), ("snapshot_id",), ledger.SNAPSHOT_FIELDS)
    statuses = file_statuses(requested, stored)
    refused = (metadata.where("status = 'conflict'").select("snapshot_id")
               .union(ledger.unexpected_roles(requested, stored).select("snapshot_id"))
               .union(statuses.where("status IN ('conflict', 'collision')").select("snapshot_id"))
               .union(requested.select("snapshot_id").join(wanted, "snapshot_id", "left_anti"))  # files of a snapshot not requested
               .distinct().withColumn("_refused", F.lit(True)))
    return statuses.join(refused, "snapshot_id", "left").withColumn("refused", F.coalesce("_refused", F.lit(False))).drop("_refused")


def register(log: CommitLog, snapshots: DataFrame, requested: DataFrame) -> tuple[DataFrame, int | None]:
    """``(files with status and refused, number of the commit or None)``; what is new and not refused is stored from then on."""
    spark = log.spark
    kept: list[DataFrame] = []

    def build(seen: int) -> dict[str, DataFrame] | None:
        path = f"{storage.scratch_root(spark)}/registrations/{storage.fresh_name()}"
        stored_snapshots, stored = log.read("snapshots", seen), log.read("files", seen)
        judged(snapshots, requested, stored_snapshots, stored).write.parquet(path)  # decided once, on this version
        out = spark.read.parquet(path)
        kept[:] = [out]
        files = out.where("status = 'new' AND NOT refused").dropDuplicates(["snapshot_id", "role"])
        own = snapshots.groupBy("snapshot_id").agg(F.min(F.struct(*ledger.SNAPSHOT_FIELDS)).alias("s")).select("snapshot_id", "s.*")
        fine = out.groupBy("snapshot_id").agg(F.max("refused").alias("r")).where("NOT r").select("snapshot_id")
        new = (own.join(fine, "snapshot_id", "left_semi").join(stored_snapshots, "snapshot_id", "left_anti"))
        if files.isEmpty() and new.isEmpty():
            return None
        return {"snapshots": new, "files": files}

    number = log.update(build)
    return kept[0].drop("_fp"), number
