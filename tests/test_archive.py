"""Write-once objects on files, and the manifest's tree of digests."""

import hashlib
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from intakeyard.operators import archive, artifacts
from intakeyard.sources import positions


def sources(tmp_path, *contents):
    folder = tmp_path / "src"
    folder.mkdir(exist_ok=True)
    for k, c in enumerate(contents):
        (folder / f"f{k}.bin").write_bytes(c)
    return str(folder)


def actions(df):
    return {r.object_key: r.action for r in df.collect()}


def planned(spark, folder):
    return artifacts.fingerprints(spark, folder).withColumn("object_key", F.concat(F.lit("a/b/"), F.element_at(F.split("path", "/"), -1)))


def test_written_reused_collision(spark, tmp_path):
    folder, root = sources(tmp_path, b"one", b"two" * 700_000, b"x"), str(tmp_path / "store")
    plan = planned(spark, folder)
    assert set(actions(archive.store(plan, root)).values()) == {"written"}
    stored = {n: (tmp_path / "store/a/b" / n).read_bytes() for n in os.listdir(f"{root}/a/b") if not n.startswith(".")}
    assert stored == {"f0.bin": b"one", "f1.bin": b"two" * 700_000, "f2.bin": b"x"}
    assert set(actions(archive.store(plan, root)).values()) == {"reused"}
    (tmp_path / "store/a/b/f0.bin").write_bytes(b"ONE")
    assert actions(archive.store(plan, root)) == {"a/b/f0.bin": "collision", "a/b/f1.bin": "reused", "a/b/f2.bin": "reused"}
    assert (tmp_path / "store/a/b/f0.bin").read_bytes() == b"ONE"


def test_a_source_that_is_not_as_planned(spark, tmp_path):
    folder, root = sources(tmp_path, b"one", b"two"), str(tmp_path / "store")
    plan = planned(spark, folder).cache()
    plan.count()
    (tmp_path / "src/f1.bin").write_bytes(b"twO")
    assert actions(archive.store(plan, root)) == {"a/b/f0.bin": "written", "a/b/f1.bin": "changed"}
    assert sorted(n for n in os.listdir(f"{root}/a/b") if not n.startswith(".")) == ["f0.bin"]


def test_one_key_planned_twice(spark, tmp_path):
    """Copies of one file share the object; other bytes under the key are a collision, whoever comes first."""
    folder, root = sources(tmp_path, b"same", b"same", b"else"), str(tmp_path / "store")
    plan = artifacts.fingerprints(spark, folder).withColumn("object_key", F.lit("k"))
    got = sorted(r.action for r in archive.store(plan, root).collect())
    kept = (tmp_path / "store/k").read_bytes()
    assert got == (["collision", "reused", "written"] if kept == b"same" else ["collision", "collision", "written"])


def test_archive_with_its_manifest(spark, tmp_path):
    folder, root = sources(tmp_path, b"one", b"two"), str(tmp_path / "store")
    out, document = archive.archive(spark, folder, root, "src/2026-01-15")
    lines = [json.loads(r.value) for r in spark.read.text(document).collect()]
    assert sorted(x["object_key"] for x in lines) == ["src/2026-01-15/f0.bin", "src/2026-01-15/f1.bin"]
    assert {x["sha256"] for x in lines} == {hashlib.sha256(b).hexdigest() for b in (b"one", b"two")}
    again, same = archive.archive(spark, folder, root, "src/2026-01-15")
    assert same == document and {r.action for r in again.collect()} == {"reused"}
    (tmp_path / "src/f0.bin").write_bytes(b"ONE")
    with pytest.raises(RuntimeError, match="1 objects not stored, first src/2026-01-15/f0.bin: collision"):
        archive.archive(spark, folder, root, "src/2026-01-15")


def brute_root(lines, fan):
    now = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    while True:
        now = [hashlib.sha256("".join(now[k:k + fan]).encode()).hexdigest() for k in range(0, len(now), fan)]
        if len(now) == 1:
            return now[0]


def test_the_root_depends_on_lines_and_order_only(spark, tmp_path):
    lines = [f"line {k} é" for k in range(30)]
    shuffled = list(enumerate(lines))
    random.Random(3).shuffle(shuffled)
    roots = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(shuffled, "at long, line string").repartition(parts)
        path = archive.write_document(spark, df, f"{tmp_path}/m{parts}")
        assert [r.value for r in positions.read_lines(spark, path).orderBy("line_no").collect()] == lines
        roots.add(archive.root_digest(spark, path, fan=4))
    assert roots == {brute_root(lines, 4)}
    for k in (0, 17, 29):
        other = [(i, x + "!" if i == k else x) for i, x in shuffled]
        path = archive.write_document(spark, spark.createDataFrame(other, "at long, line string"), f"{tmp_path}/o{k}")
        assert archive.root_digest(spark, path, fan=4) not in roots


@pytest.mark.parametrize("n", [0, 1, 4, 5, 16, 17])
def test_tree_shapes(spark, tmp_path, n):
    lines = [str(k) for k in range(n)]
    path = archive.write_document(spark, spark.createDataFrame(list(enumerate(lines)), "at long, line string"), str(tmp_path / "m"))
    nodes = archive.tree(spark, path, fan=4).collect()
    assert archive.root_digest(spark, path, fan=4) == (brute_root(lines, 4) if n else None)
    if n:
        top = max(r.level for r in nodes)
        assert [r["size"] for r in nodes if r.level == top] == [n] and sum(r["size"] for r in nodes if r.level == 0) == n
