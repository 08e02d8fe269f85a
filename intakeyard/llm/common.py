"""Small helpers the training-data operators share: row keys, checkpoints, broadcasts with a bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.session import scratch_root
from intakeyard.sources.tables import load

#: Largest local value (bytes) an operator sends to every task.
BROADCAST_LIMIT = 32 << 20
#: Shuffle files go when the execution ends that wrote them, not when the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def row_key(id_col: str, text_col: str) -> Column:
    """A key that tells rows apart by id and text together.

    Rows with the same id but other texts keep apart; rows equal in both are repeated rows
    and may share every per-text result. A null id is a value like any other.
    """
    return F.concat_ws(":", F.hex(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("~")))


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``(key, id, text)`` under fixed names, so no column of the caller can clash."""
    return docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c) for c in more])


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the folder of ``spark.checkpoint.dir``: lineage ends, any executor can reread it.

    Its shuffle files go at once, as nothing reads them again. That holds for this execution only: a frame of
    the caller that is executed again would have to make them anew."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a frame made now takes the setting
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
