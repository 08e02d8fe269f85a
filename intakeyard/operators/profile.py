"""Per-field profiling of JSON records and key checks.

All counts are conditional aggregates over one exploded pass; distinct counts and
key checks are shuffle aggregates on the key with map-side partial aggregation,
so a hot key collapses before the shuffle and no set lives on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intakeyard.functions import json_values as J


def field_values(prepared: DataFrame, value_col: str = "value", pos_col: str = "line_no"
                 ) -> DataFrame:
    """One row per (object record, key): ``(pos, field, json_type)``.

    Objects with no keys yield one row with ``field`` NULL so the first object
    record is still known.
    """
    objects = prepared.filter(F.col("_m").isNotNull())
    exploded = objects.select(pos_col, value_col,
                              F.explode_outer(F.col("_m")).alias("field", "_x"))
    raw = F.element_at(J.raw_texts(F.col(value_col)), F.col("field"))
    return exploded.select(pos_col, "field", J.json_type(F.col("_x"), raw).alias("json_type"))


def field_types(values: DataFrame) -> DataFrame:
    """A3: ``(field, json_type, n)``."""
    return (values.filter(F.col("field").isNotNull())
            .groupBy("field", "json_type").agg(F.count(F.lit(1)).alias("n")))


def field_profile(values: DataFrame, pos_col: str = "line_no") -> DataFrame:
    """A4-A6, A12 per field, plus whether the field is in the first object record."""
    per_field = values.groupBy("field").agg(
        F.array_join(F.array_sort(F.collect_set("json_type")), ",").alias("observed_types"),
        F.count_if(F.col("json_type") == "null").alias("null_count"),
        F.count(F.lit(1)).alias("observed_count"),
        F.count_if(F.col("json_type").isin("array", "object")).alias("structured_count"),
        F.min(pos_col).alias("_first_seen"),
    )
    # The first record's position is one row; keys are data, so no window gathers them in one task.
    first = per_field.agg(F.min("_first_seen").alias("_first_record"))
    return (per_field.join(F.broadcast(first))
            .select(*[c for c in per_field.columns if c != "_first_seen"],
                    (F.col("_first_seen") == F.col("_first_record")).alias("in_first_record"))
            .filter(F.col("field").isNotNull()))


def duplicate_count(df: DataFrame, key: Column) -> DataFrame:
    """Occurrences beyond the first, over non-null keys: ``(n_keys, duplicate_ids)``."""
    k = df.select(key.alias("_k")).filter(F.col("_k").isNotNull())
    per_key = k.groupBy("_k").agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n_keys"),
                       F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint")
                       .alias("duplicate_ids"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count.

    Rows with a NULL in the key are no duplicates; ``null_key_rows`` counts them.
    """
    return (df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def null_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.agg(F.count_if(cond).alias("null_key_rows"))
