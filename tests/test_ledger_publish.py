"""Ledger, publish and fingerprint behaviour on small tables and files."""

import pytest
from pyspark.sql import functions as F

from intakeyard.operators import ledger, publish
from intakeyard.operators import rules as R
from intakeyard.sources import positions

FILE = "file_id bigint, snapshot_id string, role string, filename string, object_key string, format string, sha256 string, byte_size bigint"
H1, H2, H3 = "1" * 64, "2" * 64, "3" * 64


def test_reconcile_statuses(spark):
    stored = spark.createDataFrame([
        (1, "s1", "csv", "a.csv", "k/a.csv", "csv", H1, 10),
        (2, "s1", "json", "a.json", "k/a.json", "jsonl", H2, 20),
    ], FILE)
    requested = spark.createDataFrame([
        (10, "s1", "csv", "a.csv", "k/a.csv", "csv", H1, 10),      # identical -> verified
        (11, "s1", "json", "a.json", "k/a.json", "jsonl", H2, 21),  # size differs -> conflict
        (12, "s9", "csv", "b.csv", "k/b.csv", "csv", H1, 10),      # hash owned, new snapshot -> collision
        (13, "s9", "x", "c.csv", "k/c.csv", "csv", H3, 1),         # nothing shared -> new
    ], FILE)
    snaps = spark.createDataFrame([("s1",)], "snapshot_id string")
    got = dict(ledger.reconcile(ledger.match_summaries(requested, stored), snaps).collect())
    assert got == {10: "verified", 11: "conflict", 12: "collision", 13: "new"}
    reg = {r.file_id: (r.action, r.matches_stored) for r in ledger.register(requested, stored).collect()}
    assert reg[10] == ("verify", True) and reg[11] == ("verify", False) and reg[13] == ("insert", None)


def test_guarded_transitions_and_current_version(spark):
    runs = spark.createDataFrame([
        (1, "t", "running", None), (2, "t", "succeeded", 5), (3, "t", "failed", None)],
        "run_id bigint, target string, status string, row_count bigint")
    out = spark.createDataFrame([(1, "succeeded", 7, None), (2, "succeeded", 9, None)],
                                "run_id bigint, new_status string, row_count bigint, error string")
    got = {r.run_id: (r.status, r.applied) for r in ledger.finish(runs, out).collect()}
    assert got == {1: ("succeeded", True), 2: ("succeeded", False)}
    sup = {r.run_id: (r.status, r.error) for r in ledger.supersede(runs, "t").collect()}
    assert sup[1] == ("failed", ledger.SUPERSEDED) and sup[2] == ("succeeded", None)


def test_failed_load_leaves_current_version(spark, lines_file, tmp_path):
    good = R.VENDOR.prepare(positions.read_lines(spark, lines_file(
        ['{"id":"a","website":null,"name":"A","founded":1,"size":null,"locality":null,'
         '"region":null,"country":null,"industry":null,"linkedin_url":null}'], name="good")))
    bad = R.VENDOR.prepare(positions.read_lines(spark, lines_file(['{"id":""}'], name="bad")))
    root, led = str(tmp_path / "t"), str(tmp_path / "ledger")
    first = publish.publish(spark, good, root, led, target="c", snapshot_id="s")
    assert first["status"] == "succeeded" and first["rows_stored"] == 1
    cur = publish.current_path(spark, root, led, "c")
    second = publish.publish(spark, bad, root, led, target="c", snapshot_id="s")
    assert second["status"] == "failed" and second["reason"].startswith("line 1: ")
    assert publish.current_path(spark, root, led, "c") == cur
    assert publish.orphan_folders(spark, root, led).count() == 0
    spark.read.parquet(cur).write.parquet(f"{root}/run_id=stray")
    publish.append_run(spark, led, dict(run_id="dead", snapshot_id="s", target="c", status="running"))
    third = publish.publish(spark, good.unionByName(good), root, led, target="c", snapshot_id="s")
    assert third["status"] == "failed" and third["reason"] == "1 duplicate ids"
    assert [r.run_id for r in publish.orphan_folders(spark, root, led).collect()] == ["stray"]
    dead = spark.read.parquet(led).where("run_id = 'dead' AND status = 'failed'").collect()
    assert len(dead) == 1 and dead[0].error.startswith("Superseded")


def test_empty_load_is_rejected(spark, lines_file):
    p = R.VENDOR.prepare(positions.read_lines(spark, lines_file([""], name="empty")))
    v = publish.load_verdict(p).collect()[0]
    assert v.verdict == "reject" and v.reason == "import produced no rows"


@pytest.mark.parametrize("rows,warn", [(0, True), (5, False)])
def test_empty_but_large_warning(spark, rows, warn):
    from intakeyard.operators import inventory
    counts = spark.createDataFrame([("organizations", rows)], "table_name string, exact_rows bigint")
    sizes = spark.createDataFrame([("organizations", 1, 1024 ** 3)], "table_name string, n_files bigint, total_bytes bigint")
    assert inventory.empty_but_large(counts, sizes).collect()[0].warning is warn


def test_fingerprints_use_more_than_one_task(spark, tmp_path):
    import hashlib

    from intakeyard.operators import artifacts

    for i in range(14):
        (tmp_path / f"f{i}.bin").write_bytes(bytes([i]) * (1000 * i + 1))
    got = artifacts.fingerprints(spark, str(tmp_path))
    want = {hashlib.sha256(bytes([i]) * (1000 * i + 1)).hexdigest() for i in range(14)}
    assert {r.sha256 for r in got.collect()} == want
    assert artifacts.listing(spark, str(tmp_path)).select("path").repartition(14).rdd.getNumPartitions() == 14


def test_error_leaves_a_failed_row(spark, lines_file, tmp_path):
    """A load that breaks half-way ends as ``failed`` in the ledger and publishes nothing."""
    good = R.VENDOR.prepare(positions.read_lines(spark, lines_file(
        ['{"id":"a","website":null,"name":"A","founded":1,"size":null,"locality":null,'
         '"region":null,"country":null,"industry":null,"linkedin_url":null}'], name="good")))
    rows = good.withColumn("_blank", F.raise_error(F.lit("broken source")).cast("boolean"))
    root, led = str(tmp_path / "t"), str(tmp_path / "ledger")
    with pytest.raises(Exception, match="broken source"):
        publish.publish(spark, rows, root, led, target="c", snapshot_id="s")
    runs = spark.read.parquet(led).collect()
    assert sorted(r.status for r in runs) == ["failed", "running"] and len({r.run_id for r in runs}) == 1
    assert "broken source" in next(r.error for r in runs if r.status == "failed")
    assert publish.current_path(spark, root, led, "c") is None


GOOD = ('{"id":"%s","website":null,"name":"A","founded":1,"size":null,"locality":null,'
        '"region":null,"country":null,"industry":null,"linkedin_url":null}')


def test_a_run_ends_exactly_once(spark, tmp_path):
    """Many processes end the same run at once: one ending is written, and every other caller is told so."""
    from concurrent.futures import ThreadPoolExecutor

    led = str(tmp_path / "ledger")
    run = dict(run_id="r1", snapshot_id="s", target="c")
    publish.start_run(spark, led, dict(run, status="running"))
    ends = [dict(run, status="succeeded" if k % 2 else "failed", row_count=k) for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        told = list(pool.map(lambda row: publish.end_run(spark, led, row), ends))
    rows = publish.runs_log(spark, led).read().where("status <> 'running'").collect()
    assert sum(told) == 1 and len(rows) == 1 and rows[0].row_count == told.index(True)
    assert not publish.end_run(spark, led, dict(run, status="succeeded"))
    assert not publish.end_run(spark, led, dict(run, run_id="never started", status="succeeded"))


def test_two_publishers_of_one_target(spark, lines_file, tmp_path):
    """Loads of one target at the same time: whoever starts later supersedes, and each run ends exactly once."""
    from concurrent.futures import ThreadPoolExecutor

    root, led = str(tmp_path / "t"), str(tmp_path / "ledger")
    feeds = [R.VENDOR.prepare(positions.read_lines(spark, lines_file([GOOD % k], name=f"g{k}"))) for k in range(3)]
    with ThreadPoolExecutor(3) as pool:
        done = list(pool.map(lambda p: publish.publish(spark, p, root, led, target="c", snapshot_id="s"), feeds))
    runs = publish.runs_log(spark, led).read()
    ended = {r.run_id: r.n for r in runs.where("status <> 'running'").groupBy("run_id").agg(F.count("*").alias("n")).collect()}
    assert set(ended) == {d["run_id"] for d in done} and set(ended.values()) == {1}
    good = {r.run_id for r in runs.where("status = 'succeeded'").collect()}
    assert good == {d["run_id"] for d in done if d["status"] == "succeeded"} and len(good) >= 1
    assert all(d["reason"].startswith("Superseded") for d in done if d["status"] == "failed")
    assert publish.current_path(spark, root, led, "c").split("run_id=")[1] in good


@pytest.mark.parametrize("how", ["touched", "grown", "new", "gone", "same"])
def test_a_source_that_changes_during_the_load(spark, lines_file, tmp_path, monkeypatch, how):
    import os

    folder = lines_file([GOOD % "a"], [GOOD % "b"], name="src")
    prepared = R.VENDOR.prepare(positions.read_lines(spark, folder)).cache()
    prepared.count()
    real = publish.stage

    def meddle(*args, **kw):
        out = real(*args, **kw)
        first = sorted(os.listdir(folder))[0]
        if how == "touched":
            os.utime(f"{folder}/{first}", (1, 1))
        elif how == "grown":
            with open(f"{folder}/{first}", "a") as f:
                f.write("\n")
        elif how == "new":
            with open(f"{folder}/zz.txt", "w") as f:
                f.write("x")
        elif how == "gone":
            os.rename(f"{folder}/{first}", f"{tmp_path}/elsewhere")
        return out

    monkeypatch.setattr(publish, "stage", meddle)
    root, led = str(tmp_path / "t"), str(tmp_path / "ledger")
    done = publish.publish(spark, prepared, root, led, target="c", snapshot_id="s", source=folder)
    prepared.unpersist()
    if how == "same":
        assert done["status"] == "succeeded"
    else:
        assert done["status"] == "failed" and done["reason"].startswith("source changed during the load: 1 files")
        assert publish.current_path(spark, root, led, "c") is None
        assert [r.status for r in publish.runs_log(spark, led).read().where("status <> 'running'").collect()] == ["failed"]


def test_a_listing_task_lists_many_folders(spark, tmp_path):
    from intakeyard.sources import files

    for i in range(100):
        (tmp_path / f"run_id={i}").mkdir()
        (tmp_path / f"run_id={i}" / "a.parquet").write_bytes(b"x")
    spark.sparkContext.setJobGroup("listing", "many folders")
    try:
        found = files.listing(spark, str(tmp_path), "*.parquet")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert found.count() == 100 and tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism


def test_requests_do_not_read_the_texts_again(spark, monkeypatch):
    from intakeyard.operators import registry
    from intakeyard.plans import catalog

    got, register = [], registry.register
    monkeypatch.setattr(registry, "register", lambda log, snapshots, requested: got.extend((snapshots, requested)) or register(log, snapshots, requested))
    catalog.QUERIES["registration_outcomes"](spark, "/root/testdata/sf0.001")
    assert len(got) == 6 and not any("documents.parquet" in f for df in got for f in df.inputFiles())


def test_folders_are_made_as_partition_by_makes_them(spark, tmp_path):
    """Same folders and rows, keys spelled alike, a folder's rows whole across Arrow batches (of 1,000 rows)."""
    from intakeyard.sources import files

    keys = [None, "", "a b", "x/y:z=%", "7"]
    df = spark.createDataFrame([(keys[i % 5] if i < 40 else "hot", i, f"v{i}") for i in range(3000)], "k string, i bigint, v string")
    df = df.withColumn("at", F.timestamp_seconds("i"))
    df.write.partitionBy("k").parquet(str(tmp_path / "want"))
    files.write_folders(spark, df, str(tmp_path / "got"), "k")
    held = {n: {p.name for p in (tmp_path / n).iterdir() if not p.name.startswith((".", "_SUCCESS"))} for n in ("want", "got")}
    assert held["got"] == held["want"] and len(held["got"]) == 5
    assert all(sum(1 for _ in (tmp_path / "got" / n).iterdir()) == 1 for n in held["got"])
    want, got = (sorted(map(tuple, spark.read.parquet(str(tmp_path / n)).select("i", "v", "at", "k").collect())) for n in ("want", "got"))
    assert got == want and len(got) == 3000


def test_making_folders_starts_no_process_a_file(spark, tmp_path):
    """Hadoop without its native library starts a ``chmod`` for every local file and one for its checksum."""
    from intakeyard.sources import files

    def started():
        with open("/proc/stat") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("processes"))

    df = spark.range(600).withColumn("v", F.col("id") * 2)
    files.write_folders(spark, df.limit(3), str(tmp_path / "warm"), "id")
    before = started()
    files.write_folders(spark, df, str(tmp_path / "t"), "id")
    assert started() - before < 600 and spark.read.parquet(str(tmp_path / "t")).where("v = id * 2").count() == 600


@pytest.mark.parametrize("glob", ["*", "*.parquet"])
def test_a_listing_finds_what_spark_finds(spark, tmp_path, glob):
    from intakeyard.operators import artifacts
    from intakeyard.sources import files

    for name in ("a.parquet", "b.txt", "run_id=1/a.parquet", "run_id=1/.a.parquet.crc", "_landing/run_id=2/a.parquet", "_k=1/a.parquet", "x y/deep/er/ä.parquet",
                 "run_id=3/empty.parquet", "run_id=4/_staged.parquet", "run_id=5/c.parquet._COPYING_"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else name.encode())
    (tmp_path / "run_id=6").mkdir()
    want = sorted(map(tuple, artifacts.listing(spark, str(tmp_path), glob).collect()))
    assert sorted(map(tuple, files.listing(spark, str(tmp_path), glob).collect())) == want and len(want) == (5 if glob == "*" else 4)


def test_a_listing_is_read_by_few_tasks(spark, tmp_path):
    from intakeyard.sources import files

    for i in range(300):
        (tmp_path / f"run_id={i}").mkdir()
        (tmp_path / f"run_id={i}" / "a.parquet").write_bytes(b"x")
    found = files.listing(spark, str(tmp_path), "*.parquet")
    assert found.count() == 300 and found.rdd.getNumPartitions() < 50
