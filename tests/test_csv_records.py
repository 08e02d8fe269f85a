"""The split-safe CSV scan against Python's own ``csv`` module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from intakeyard.sources import csv_records

HARD = ['a,b,c', '"x ""y""",2,3', '"b\\slash",2,3', '"he said \\"hi\\", then left",2,3', '"two\nlines",2,3', '1,2,3,', '1,2,3,,x', '',
        '"tail"after,2,3', 'mid"quote,2,3', '"a""",2,3', '"\\\\",2,3', '\\,x,2,3', '"",,', ',,', '"three\n\n""lines"" here\n",2,3', '"end\\""x,2,3', "1,2"]


def _expected(text, **dialect):
    return [r for r in csv.reader(io.StringIO(text, newline=""), **dialect) if r]


def _got(spark, path, dialect):
    rows = csv_records.records(spark, path, dialect).select("pos", dialect.cells(F.col("record")).alias("c")).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, len(rows) + 1))
    return [r.c for r in rows]


@pytest.mark.parametrize("split", ["128m", "300"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_matches_python_csv(spark, tmp_path, split, end):
    rng = random.Random(11)
    rows = HARD + [rng.choice(HARD) for _ in range(150)]
    text = end.join(rows) + end
    path = tmp_path / "hard.csv"
    path.write_bytes(text.encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert (spark.read.text(str(path)).rdd.getNumPartitions() > 4) == (split == "300")
        assert _got(spark, str(path), csv_records.VENDOR) == _expected(text, escapechar="\\")
        assert _got(spark, str(path), csv_records.DEFAULT) == _expected(text)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_read_csv_counts_cells(spark, tmp_path):
    (tmp_path / "f.csv").write_text('x,y\n1,2,\n3\n4,5,,z\n"open,6\n')
    rows = csv_records.read_csv(spark, str(tmp_path / "f.csv"), ("x", "y"), csv_records.VENDOR).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [(1, "1", "2", 3), (2, "3", None, 1), (3, "4", "5", 4), (4, "open,6", None, 1)]
    assert csv_records.header(spark, str(tmp_path / "f.csv"), csv_records.VENDOR).first()["cells"] == ["x", "y"]


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert csv_records.read_csv(spark, str(tmp_path / "e.csv"), ("x",), csv_records.VENDOR).count() == 0


def test_long_record(spark, tmp_path):
    """Many quotes in one cell: the regex loops neither recurse nor back up."""
    cell = '"' + 'ab""cd\\"' * 40000 + '"'
    (tmp_path / "l.csv").write_text("x,y\n" + cell + ",2\n")
    got = csv_records.read_csv(spark, str(tmp_path / "l.csv"), ("x", "y"), csv_records.VENDOR).first()
    assert got["x"] == 'ab"cd"' * 40000 and got["n_cells"] == 2


def _splits(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return before


@pytest.mark.parametrize("split", [128, 100_000])
def test_a_quote_that_never_closes(spark, tmp_path, split):
    """The rest of the file is one record; above the stated size it is named and nothing gathers its text."""
    rows = ["x,y", "1,2", '3,"two', 'lines"', '5,"open'] + [f"line {k},{k}" for k in range(400)]
    text = "\n".join(rows) + "\n"
    (tmp_path / "r.csv").write_text(text)
    before = _splits(spark, split)
    try:
        whole = csv_records.records(spark, str(tmp_path / "r.csv"), csv_records.VENDOR).orderBy("pos").collect()
        assert [r.error for r in whole] == [None] * 4 and whole[3].record == "\n".join(rows[4:])
        cut = csv_records.records(spark, str(tmp_path / "r.csv"), csv_records.VENDOR, max_record=600).orderBy("pos").collect()
        assert [r.record for r in cut[:3]] == [r.record for r in whole[:3]]
        size = len("\n".join(rows[4:]))
        assert cut[3].record is None and cut[3].error == f"record of {size} bytes, over 600"
        got = csv_records.read_csv(spark, str(tmp_path / "r.csv"), ("x", "y"), csv_records.VENDOR, 600, with_errors=True).orderBy("pos").collect()
        assert [(r.x, r.y, r.n_cells) for r in got] == [("1", "2", 2), ("3", "two\nlines", 2), (None, None, None)]
        assert got[2].error is not None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_line_above_the_size(spark, tmp_path):
    (tmp_path / "w.csv").write_text("x,y\n" + "a" * 5000 + ",1\n2,3\n")
    got = csv_records.read_csv(spark, str(tmp_path / "w.csv"), ("x", "y"), csv_records.DEFAULT, 4096, with_errors=True).orderBy("pos").collect()
    assert [(r.x, r.y, r.n_cells, r.error) for r in got] == [(None, None, None, "record of 5002 bytes, over 4096"), ("2", "3", 2, None)]


def test_only_records_over_several_splits_are_shuffled(spark, tmp_path):
    """The one exchange of texts is fed by lines of splits that such records touch."""
    (tmp_path / "p.csv").write_text("x,y\n" + "".join(f"{k},{k}\n" for k in range(50)))
    plan = csv_records.records(spark, str(tmp_path / "p.csv"), csv_records.VENDOR)._jdf.queryExecution().optimizedPlan().toString()
    branch = plan[plan.index("Aggregate [pos"):]
    assert branch.count("(_in") >= 1 and "Filter" in branch and plan.count("Aggregate [pos") == 1


def test_random_texts_against_python(spark, tmp_path):
    """Random mixes of quotes, escapes, commas and line ends, cut at every few bytes."""
    rng = random.Random(29)
    for round_ in range(3):
        cells = ['"', '""', ",", "\n", "a", "b c", "\\", '","', '"x"', "\n\n", '"\n"']
        text = "h\n" + "".join(rng.choice(cells) for _ in range(600)).replace("\\\n", "\n")
        path = tmp_path / f"r{round_}.csv"
        path.write_bytes(text.encode())
        before = _splits(spark, 64)
        try:
            assert _got(spark, str(path), csv_records.DEFAULT) == _expected(text)
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
