"""Numbered commits: exclusive, whole, and repeated work adds nothing."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import types as T

from intakeyard.sources import files
from intakeyard.sources.commits import CommitLog

ONE = {"": T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])}
TWO = {"a": T.StructType([T.StructField("x", T.LongType())]), "b": T.StructType([T.StructField("y", T.StringType())])}


def test_commits_are_exclusive(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), ONE)
    assert log.version() == 0 and log.read().collect() == []
    rows = [spark.createDataFrame([(k, f"w{k}")], ONE[""]) for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(lambda r: log.try_commit({"": r}, 0), rows))
    assert sum(won) == 1 and log.version() == 1
    assert [r.k for r in log.read().collect()] == [won.index(True)]
    assert [n for n in files.names(spark, log.root) if n.startswith("_staged")] == []


def test_losers_look_again(spark, tmp_path):
    """Six writers add one row each through ``update``: all rows are there, each once."""
    log = CommitLog(spark, str(tmp_path / "t"), ONE)
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda k: log.update(lambda v: {"": spark.createDataFrame([(k, str(v))], ONE[""])}), range(6)))
    assert sorted(numbers) == [1, 2, 3, 4, 5, 6]
    got = log.read().collect()
    assert sorted(r.k for r in got) == list(range(6)) and all(int(r.v) == r.commit - 1 for r in got)
    assert sorted(r.commit for r in log.read(upto=3).collect()) == [1, 2, 3]


def test_several_tables_in_one_commit(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), TWO)
    a, b = spark.createDataFrame([(1,)], "x long"), spark.createDataFrame([("p",), ("q",)], "y string")
    assert log.try_commit({"a": a, "b": b}, 0) and not log.try_commit({"a": a, "b": b}, 0)
    assert log.read("a").count() == 1 and log.read("b").count() == 2
    assert log.update(lambda v: None) is None and log.version() == 1


def test_filters_reach_the_scan(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), ONE)
    log.try_commit({"": spark.createDataFrame([(1, "a"), (2, "b")], ONE[""])}, 0)
    plan = log.read().where("k = 2").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,2)" in plan


def test_an_error_while_writing_commits_nothing(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), ONE)
    bad = spark.createDataFrame([(1, "a")], ONE[""]).selectExpr("k", "raise_error('no') AS v")
    with pytest.raises(Exception, match="no"):
        log.try_commit({"": bad}, 0)
    assert log.version() == 0
