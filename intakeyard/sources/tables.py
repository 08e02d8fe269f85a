"""The given parquet tables, read by path (filters and projections push into the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def sql_ref(sf_dir: str, name: str) -> str:
    """A table reference usable inside Spark SQL text."""
    return f"parquet.`{table_path(sf_dir, name)}`"
