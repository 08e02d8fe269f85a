"""Reports are ordered, lazy tables; counts under a time bound end in one of three ways."""

import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from intakeyard.operators import inventory, reports

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["inspect_report", "inv_report"])
def test_rows_come_in_order(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    by = (lambda r: (r.section_rank, r.row_rank, r["item"])) if name == "inspect_report" else (lambda r: (r.section_rank, r.section, r.row_rank, r["item"]))
    assert rows and [by(r) for r in rows] == sorted(by(r) for r in rows)


def test_inspection_runs_nothing_before_it_is_asked(spark):
    """The figures are selected, not collected: an input that fails does so only when the report is read."""
    bad = spark.range(1).select(F.raise_error(F.lit("read")).cast("array<string>").alias("cells"))
    one = lambda **c: spark.createDataFrame([tuple(c.values())], list(c))
    empty = spark.createDataFrame([], "field string, n long")
    out = reports.inspection(
        header=bad, expected_header=("a",), first_fields=one(fields=["id", "x"]), expected_fields=("id", "x"), probes=one(order_ok=True),
        profile=spark.createDataFrame([("x", "string", 1234, 5000), ("late", "null", 1, 1)], "field string, observed_types string, null_count long, observed_count long"),
        samples=one(line_no=1, rendered="{}"), summary=one(records_compared=1, id_mismatches=0, duplicate_json_ids=0, malformed_csv_rows=0, structured_values=0),
        mismatches=empty, divergence=spark.createDataFrame([(None, 7)], "first_malformed_row long, first_id_mismatch long"))
    with pytest.raises(Exception, match="read"):
        out.collect()
    got = {(r.section, r["item"]): (r.row_rank, r.value) for r in out.where("section <> 'csv'").collect()}
    assert got["field", "x"] == (2, "string (null in 1,234 of 5,000)") and got["field", "late"][0] == reports.LATER
    assert got["csv against json", "differing cells by field"][1] == "none" and got["csv against json", "plain dialect: first row too wide"][1] == "none"


def test_inventory_report(spark):
    counts = spark.createDataFrame([("b", 0, None), ("a", None, "timed out after 2 seconds"), ("c", 1234567, None)], "table_name string, exact_rows long, count_error string")
    sizes = spark.createDataFrame([("a", 1, 10), ("b", 2, 2**30), ("c", 1, 2048)], "table_name string, n_files long, total_bytes long")
    columns = spark.createDataFrame([("a", 2, "y", "int", True), ("a", 1, "x", "string", False), ("b", 1, "z", "int", True)], inventory.COLUMN_SCHEMA)
    keys = spark.createDataFrame([("a", "y"), ("a", "x")], "table_name string, column_name string")
    rows = reports.inventory(counts=counts, sizes=sizes, columns=columns, keys=keys, threshold=2**20, partitioned=F.col("table_name") == "c").collect()
    got = [(r.section, r["item"], r.value) for r in rows]
    assert got == [
        ("all tables", "tables", "3"), ("all tables", "bytes on disk", "1.00 GiB"),
        ("a", "type", "table"), ("a", "rows", "unknown; counting timed out after 2 seconds"), ("a", "size", "10 B"), ("a", "columns", "2"),
        ("a", "column x", "string NOT NULL"), ("a", "column y", "int NULL"), ("a", "unique columns", "x, y"),
        ("b", "type", "table"), ("b", "rows", "0"), ("b", "size", "1.00 GiB"), ("b", "columns", "1"), ("b", "column z", "int NULL"), ("b", "unique columns", "none"),
        ("b", "warning", "no rows in 1,073,741,824 bytes"),
        ("c", "type", "partitioned table"), ("c", "rows", "1,234,567"), ("c", "size", "2.00 KiB"), ("c", "columns", "none"), ("c", "unique columns", "none")]


@pytest.mark.parametrize("exact,error,estimate,text", [
    (1234, None, 9, "1,234"), (None, "timed out after 5 seconds", 1200, "about 1,200; counting timed out after 5 seconds"),
    (None, "failed: x", None, "unknown; counting failed: x"), (None, None, 1200, "about 1,200"), (None, None, None, "unknown")])
def test_row_count_text(spark, exact, error, estimate, text):
    df = spark.createDataFrame([(exact, error, estimate)], "e long, r string, s long")
    assert df.select(reports.row_count_text(F.col("e"), F.col("r"), F.col("s"))).first()[0] == text


def test_counts_end_in_three_ways(spark):
    slow = spark.range(0, 60, 1, 1).select(F.expr("reflect('java.lang.Thread', 'sleep', 400L)").alias("s")).where("s IS NULL")
    bad = spark.range(3).where(F.raise_error(F.lit("no such block")).isNotNull())
    assert inventory.bounded_counts(spark, {"fine": spark.range(7)}, 120).first().exact_rows == 7  # code is compiled from here on
    began = time.time()
    got = {r.table_name: r for r in inventory.bounded_counts(spark, {"slow": slow, "fine": spark.range(7), "bad": bad, "slow too": slow}, 4).collect()}
    took = time.time() - began
    assert got["fine"].exact_rows == 7 and got["fine"].count_error is None
    assert got["slow"].count_error == got["slow too"].count_error == "timed out after 4 seconds" and got["slow"].exact_rows is None
    assert got["bad"].count_error.startswith("failed: ") and "no such block" in got["bad"].count_error
    assert took < 20  # either slow one takes 24 seconds if it is not ended
    assert spark.range(5).count() == 5
    with pytest.raises(ValueError):
        inventory.bounded_counts(spark, {"fine": spark.range(7)}, 0)
