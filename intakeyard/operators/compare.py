"""Cross-representation comparison: the i-th record of one encoding against the
i-th record of another (a positional equi-join on contiguous positions).

Both sides carry positions from ``sources.positions``; the join is an equi-join
on a unique key, so it never fans out and a skewed value cannot pile up on one
task. Everything the reference gathered in one loop (counters, id set, per-field
mismatch counters) is one conditional aggregate over the joined rows.

Semantics follow Python equality on decoded values: CSV cells are normalised
(``''`` -> null, ``founded`` -> int), JSON values keep their JSON type; an absent
JSON key equals an empty CSV cell; ``2020 == 2020.0``; a string never equals a
number. A JSON line that is not an object compares as an empty record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intakeyard.functions import json_values as J


def csv_normalized(csv: DataFrame, header: tuple[str, ...], int_fields: tuple[str, ...] = ("founded",)
                   ) -> DataFrame:
    """``''`` and missing -> null; integer fields cast, with a violation flag."""
    out = [F.col("pos")]
    bad = F.lit(False)
    for f in header:
        v = F.nullif(F.col(f), F.lit(""))
        if f in int_fields:
            cast = F.expr(f"try_cast(nullif({f}, '') AS INT)")
            bad = bad | (v.isNotNull() & cast.isNull())
            out.append(cast.alias(f))
        else:
            out.append(v.alias(f))
    return csv.select(*out, bad.alias("founded_not_integer"))


def _json_equal(csv_norm: Column, x: Column, t: Column, integer: bool) -> Column:
    """Null-safe Python equality of a normalised CSV value and a JSON value."""
    absent_or_null = x.isNull() | (t == "VOID")
    if integer:
        typed = (J.is_numeric_type(t) | (t == "BOOLEAN")) & (csv_norm.cast("double") == J.as_double(x))
    else:
        typed = (t == "STRING") & (csv_norm == J.as_string(x))
    return F.coalesce(F.when(csv_norm.isNull(), absent_or_null).otherwise(typed), F.lit(False))


def joined(csv: DataFrame, prepared_json: DataFrame, header: tuple[str, ...],
           int_fields: tuple[str, ...] = ("founded",), keep_all: bool = False) -> DataFrame:
    """Positional join plus per-row comparison flags.

    Output: ``pos, id_match, n_cells, founded_not_integer, json_id, json_id_is_string,
    structured, mm_<field>`` (mismatch flags, set only when ids match). ``keep_all`` keeps records that only
    one side has and adds ``in_csv`` and ``in_json``.
    """
    n_header = len(header)
    c = csv.select("pos", *[F.col(f).alias(f"c_{f}") for f in header], "n_cells")
    m = F.col("_m")
    j = prepared_json.select(F.col("line_no").alias("pos"), "_m")
    sides = [F.coalesce(s, F.lit(False)) for s in (F.col("in_csv"), F.col("in_json"))]
    both = (c.withColumn("in_csv", F.lit(True)).join(j.withColumn("in_json", F.lit(True)), "pos", "full" if keep_all else "inner")
            .withColumns({"in_csv": sides[0], "in_json": sides[1]}))
    json_fields = both.select("*", *[F.schema_of_variant(J.field(m, f)).alias(f"t_{f}")
                                     for f in header])
    raw_id = F.col("c_id")
    id_match = F.coalesce(
        F.when(raw_id.isNull(), J.field(m, "id").isNull() | (F.col("t_id") == "VOID"))
        .otherwise((F.col("t_id") == "STRING") & (raw_id == J.as_string(J.field(m, "id")))),
        F.lit(False))
    cols = [F.col("pos"), *([F.col("in_csv"), F.col("in_json")] if keep_all else []), id_match.alias("id_match"), F.col("n_cells"),
            (F.col("n_cells") > n_header).alias("too_long")]
    not_int = F.lit(False)
    structured = F.lit(0)
    for f in header:
        cv = F.nullif(F.col(f"c_{f}"), F.lit(""))
        t = F.col(f"t_{f}")
        x = J.field(m, f)
        if f in int_fields:
            cast = cv.try_cast("int")
            not_int = not_int | (id_match & cv.isNotNull() & cast.isNull())
            eq = _json_equal(cast, x, t, True)
        else:
            eq = _json_equal(cv, x, t, False)
        cols.append((id_match & ~eq).alias(f"mm_{f}"))
    for f in header:
        t = F.col(f"t_{f}")
        structured = structured + F.when(t.startswith("ARRAY") | t.startswith("OBJECT"), 1).otherwise(0)
    cols += [not_int.alias("founded_not_integer"), structured.alias("structured"),
             F.when(F.col("t_id") == "STRING", J.as_string(J.field(m, "id"))).alias("json_id")]
    return json_fields.select(*cols)


def positional_compare(rows: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """Per position, whether ids align and which header fields differ."""
    names = F.filter(F.array(*[F.when(F.col(f"mm_{f}"), F.lit(f)) for f in sorted(header)]),
                     lambda x: x.isNotNull())
    return rows.select("pos", "id_match", F.array_join(names, ",").alias("mismatched_fields"))


def field_mismatches(rows: DataFrame, header: tuple[str, ...]) -> DataFrame:
    """Mismatch count per CSV header field where ids align; zero counts omitted."""
    per = rows.select(F.explode(F.array(*[
        F.when(F.col(f"mm_{f}"), F.lit(f)) for f in header])).alias("field"))
    return (per.filter(F.col("field").isNotNull())
            .groupBy("field").agg(F.count(F.lit(1)).alias("n")))


def summary(rows: DataFrame) -> DataFrame:
    """A10, A11, A14 and friends, plus both full record counts, of rows joined with ``keep_all``.

    Each side is read once: all counters are partial sums per JSON id (rows without one fall together
    and are combined before the shuffle), added up in a second aggregate.
    """
    both = F.col("in_csv") & F.col("in_json")
    flags = {"records_compared": both, "id_mismatches": both & ~F.col("id_match"), "malformed_csv_rows": both & F.col("too_long"),
             "founded_not_integer": both & F.col("founded_not_integer"), "csv_records": F.col("in_csv"), "json_records": F.col("in_json")}
    per_id = rows.groupBy(F.when(both, F.col("json_id")).alias("json_id")).agg(
        *[F.count_if(c).alias(n) for n, c in flags.items()], F.sum(F.when(both, F.col("structured"))).alias("structured_values"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per_id.agg(*[total(c).alias(c) for c in (*flags, "structured_values")],
                      total(F.when(F.col("json_id").isNotNull(), F.col("records_compared") - 1)).alias("duplicate_json_ids"))


def first_divergence(rows: DataFrame) -> DataFrame:
    """First over-long row and first id divergence, as two ``min(when(...))``."""
    return rows.agg(F.min(F.when(F.col("too_long"), F.col("pos"))).alias("first_malformed_row"),
                    F.min(F.when(~F.col("id_match"), F.col("pos"))).alias("first_id_mismatch"))
