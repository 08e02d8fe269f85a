"""The vendor feed as files: a JSONL file and the prepared (parsed) lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.operators.rules import VENDOR, RuleSet
from intakeyard.session import configure
from intakeyard.sources import csv_records, files, positions, seek, standins


def vendor_json_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the JSONL stand-in once (4 part files, line order kept) and return its folder."""
    path = files.fixture_dir(spark, sf_dir, "vendor_jsonl")
    if files.exists(spark, f"{path}/_SUCCESS"):
        return path
    return files.write_lines(spark, standins.standin(spark, sf_dir, "vendor_json"), path)


def vendor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_no, value)`` read back from the JSONL files."""
    configure(spark)
    return positions.read_lines(spark, vendor_json_path(spark, sf_dir))


def vendor_prepared(spark: SparkSession, sf_dir: str, rules: RuleSet = VENDOR, window: int | None = None) -> DataFrame:
    """Parsed lines; a ``window`` reads the first lines only."""
    if window is None:
        return rules.prepare(vendor_lines(spark, sf_dir))
    configure(spark)
    return rules.prepare(seek.first_lines(spark, vendor_json_path(spark, sf_dir), window))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def vendor_csv_path(spark: SparkSession, sf_dir: str) -> str:
    """Write the vendor CSV once and return its folder: alphabetical header, cells with and without quotes, doubled
    and backslashed quotes, backslashes before other characters, line ends in cells, surplus cells."""
    path = files.fixture_dir(spark, sf_dir, "vendor_csv")
    if files.exists(spark, f"{path}/_SUCCESS"):
        return path
    csv = standins.standin(spark, sf_dir, "vendor_csv")
    doubled, backslashed = F.replace("raw_name", F.lit('"'), F.lit('""')), F.replace("raw_name", F.lit('"'), F.lit('\\"'))
    raw = {"name": _quoted(F.when(F.col("k") % 100 == 7, doubled).otherwise(backslashed)), "id": _quoted(F.col("id")),
           "website": _quoted(F.col("website")), "linkedin_url": _quoted(F.col("linkedin_url"))}
    surplus = F.element_at(F.create_map(F.lit(18), F.lit(',"surplus"'), F.lit(19), F.lit(","), F.lit(20), F.lit(",,more")),
                           (F.col("pos") % 103).cast("int"))
    body = F.concat(F.concat_ws(",", *[raw.get(c, F.col(c)) for c in standins.CSV_HEADER]), F.coalesce(surplus, F.lit("")))
    head = spark.range(1).select(F.lit(0).cast("bigint").alias("line_no"), F.lit(",".join(standins.CSV_HEADER)).alias("value"))
    lines = head.unionByName(csv.select(F.col("pos").alias("line_no"), body.alias("value")))
    return files.write_lines(spark, lines, path)


def vendor_csv(spark: SparkSession, sf_dir: str, dialect: csv_records.Dialect = csv_records.VENDOR, window: int | None = None) -> DataFrame:
    """``(pos, *header fields, n_cells)`` read back from the CSV files, the first ``window`` records if given."""
    return csv_records.read_csv(spark, vendor_csv_path(spark, sf_dir), standins.CSV_HEADER, dialect, first=window)
