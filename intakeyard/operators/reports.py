"""Reports as long tables ``(section_rank, row_rank, section, item, value)`` in global order.

Every line is selected from the aggregate it states, so a report is one lazy DataFrame and nothing is gathered on the driver. Lines are
ordered by section, then by their rank in it, then by item, which tells apart lines of one rank (fields that only some records have).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intakeyard.functions import scalars

#: Rank of fields that the first record does not have.
LATER = 1_000_000


def lines(df: DataFrame, section_rank: int | Column, section: str | Column, *items: tuple[int | Column, str | Column, Column]) -> DataFrame:
    """One report line per row of ``df`` and ``(rank, item, value)``; a line without a value is left out."""
    as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
    made = F.array(*[F.struct(as_col(r).cast("bigint").alias("row_rank"), as_col(i).alias("item"), v.cast("string").alias("value")) for r, i, v in items])
    out = df.select(as_col(section_rank).cast("int").alias("section_rank"), as_col(section).alias("section"), F.explode(made).alias("l"))
    return out.select("section_rank", "l.row_rank", "section", "l.item", "l.value").where(F.col("value").isNotNull())


def ordered(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).orderBy("section_rank", "row_rank", "item")


def number(n: Column) -> Column:
    """With thousands separators; ``none`` for null."""
    return F.coalesce(scalars.thousands(n), F.lit("none"))


def row_count_text(exact: Column, error: Column, estimate: Column | None = None) -> Column:
    """An exact count, else what is known instead and why there is none."""
    about = F.lit("unknown") if estimate is None else F.coalesce(F.concat(F.lit("about "), scalars.thousands(estimate)), F.lit("unknown"))
    return (F.when(exact.isNotNull(), scalars.thousands(exact)).when(error.isNotNull(), F.concat(about, F.lit("; counting "), error)).otherwise(about))


def kind_text(partitioned: Column) -> Column:
    """X10."""
    return F.when(partitioned, "partitioned table").otherwise("table")


def inspection(*, header: DataFrame, expected_header: tuple[str, ...], first_fields: DataFrame, expected_fields: tuple[str, ...], probes: DataFrame,
               profile: DataFrame, samples: DataFrame, summary: DataFrame, mismatches: DataFrame, divergence: DataFrame) -> DataFrame:
    """Header and field checks, types and nulls, samples, comparison.

    ``header`` ``(cells)`` and ``first_fields`` ``(fields)`` have at most one row, the others are the results of their operators."""
    declared = lambda c, names: scalars.yes_no(F.col(c) == F.array(*[F.lit(n) for n in names]))
    at = F.array_position("fields", F.col("field"))
    seen = profile.join(F.broadcast(first_fields))  # one row
    types = F.concat(F.replace("observed_types", F.lit(","), F.lit(", ")), F.lit(" (null in "), number(F.col("null_count")), F.lit(" of "),
                     number(F.col("observed_count")), F.lit(")"))
    differing = F.array_join(F.array_sort(F.collect_list(F.concat("field", F.lit("="), number(F.col("n"))))), ", ")  # one entry per header field
    return ordered([
        lines(header, 1, "csv", (1, "column order", F.array_join("cells", ", ")), (2, "column order as declared", declared("cells", expected_header))),
        lines(first_fields, 2, "json", (1, "fields of line 1", F.array_join("fields", ", ")), (2, "fields as declared", declared("fields", expected_fields))),
        lines(probes.agg(F.count_if(~F.col("order_ok")).alias("bad"), F.count(F.lit(1)).alias("n")), 2, "json",
              (3, "lines probed for field order", F.concat(F.col("bad").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" differ")))),
        lines(seen, 3, "field", (F.when(at > 0, at).otherwise(LATER), F.col("field"), types)),
        lines(samples, 4, "example line", (F.col("line_no"), F.col("line_no").cast("string"), F.col("rendered"))),
        lines(summary, 5, "csv against json", (1, "pairs of records", number(F.col("records_compared"))), (2, "pairs with other ids", number(F.col("id_mismatches"))),
              (3, "json ids seen again", number(F.col("duplicate_json_ids"))), (4, "csv rows with too many cells", number(F.col("malformed_csv_rows"))),
              (8, "nested values", number(F.col("structured_values")))),
        lines(mismatches.agg(F.nullif(differing, F.lit("")).alias("cells")), 5, "csv against json", (5, "differing cells by field", F.coalesce("cells", F.lit("none")))),
        lines(divergence, 5, "csv against json", (6, "plain dialect: first row too wide", number(F.col("first_malformed_row"))),
              (7, "plain dialect: first other id", number(F.col("first_id_mismatch")))),
    ])


def inventory(*, counts: DataFrame, sizes: DataFrame, columns: DataFrame, keys: DataFrame, threshold: int, partitioned: Column | None = None) -> DataFrame:
    """R2: per table its kind, rows, size, columns, unique columns and warnings, tables by name behind the totals.

    ``counts`` has ``(table_name, exact_rows, count_error)``; one row per table on every side but ``columns`` and ``keys``."""
    table = F.col("table_name")
    per = columns.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_columns"))
    unique = keys.groupBy("table_name").agg(F.array_join(F.array_sort(F.collect_list("column_name")), ", ").alias("unique"))
    known = counts.join(sizes, "table_name", "left").join(per, "table_name", "left").join(unique, "table_name", "left")
    heavy = (F.col("exact_rows") == 0) & (F.col("total_bytes") >= threshold)
    whole = sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("total_bytes"), F.lit(0)).cast("bigint").alias("bytes"))
    return ordered([
        lines(whole, 0, "all tables", (1, "tables", number(F.col("n"))), (2, "bytes on disk", scalars.format_bytes(F.col("bytes")))),
        lines(known, 1, table, (1, "type", kind_text(F.lit(False) if partitioned is None else partitioned)),
              (2, "rows", row_count_text(F.col("exact_rows"), F.col("count_error"))), (3, "size", scalars.format_bytes(F.col("total_bytes"))),
              (4, "columns", number(F.col("n_columns"))), (LATER, "unique columns", F.coalesce("unique", F.lit("none"))),
              (LATER + 1, "warning", F.when(heavy, F.concat(F.lit("no rows in "), scalars.thousands(F.col("total_bytes")), F.lit(" bytes"))))),
        lines(columns, 1, table, (F.col("position") + 4, F.concat(F.lit("column "), F.col("column_name")),
                                  F.concat("data_type", F.when(F.col("nullable"), " NULL").otherwise(" NOT NULL")))),
    ]).orderBy("section_rank", "section", "row_rank", "item")
