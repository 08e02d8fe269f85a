"""The stored ledger: registered once, verified from then on, whole snapshots refused, two writers at once."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from intakeyard.operators import registry

H = [str(k) * 64 for k in range(9)]


def snaps(spark, *ids, description="d"):
    return spark.createDataFrame([(i, "src", "ds", f"2026-01-{k + 1:02d}", f"{i}/manifest.json", None, description) for k, i in enumerate(ids)], registry.SNAPSHOTS)


def files(spark, *rows):
    """``(snapshot, role, hash[, size[, key]])``"""
    return spark.createDataFrame([(k, r[0], r[1], f"{r[1]}.txt", r[4] if len(r) > 4 else f"{r[0]}/{r[1]}.txt", "txt", r[2], r[3] if len(r) > 3 else 1)
                                  for k, r in enumerate(rows)], registry.FILES)


@pytest.fixture
def log(spark, tmp_path):
    out = registry.registry(spark, str(tmp_path / "reg"))
    _, number = registry.register(out, snaps(spark, "s1"), files(spark, ("s1", "a", H[0]), ("s1", "b", H[1])))
    assert number == 1
    return out


def result(out):
    return {(r.snapshot_id, r.role): (r.status, r.refused) for r in out.collect()}


def test_again_writes_nothing(spark, log):
    out, number = registry.register(log, snaps(spark, "s1"), files(spark, ("s1", "a", H[0]), ("s1", "b", H[1])))
    assert number is None and log.version() == 1 and log.read("files").count() == 2 and log.read("snapshots").count() == 1
    assert result(out) == {("s1", "a"): ("verified", False), ("s1", "b"): ("verified", False)}


def test_missing_files_are_added(spark, log):
    out, number = registry.register(log, snaps(spark, "s1"), files(spark, ("s1", "a", H[0]), ("s1", "b", H[1]), ("s1", "c", H[2])))
    assert number == 2 and result(out)["s1", "c"] == ("new", False)
    assert sorted((r.role, r.commit) for r in log.read("files").collect()) == [("a", 1), ("b", 1), ("c", 2)]
    assert log.read("snapshots").count() == 1


@pytest.mark.parametrize("rows,refused", [
    ([("s1", "a", H[3]), ("s1", "b", H[1]), ("s1", "c", H[2])], "conflict"),
    ([("s1", "a", H[0], 9), ("s1", "b", H[1]), ("s1", "c", H[2])], "conflict"),
    ([("s1", "a", H[0]), ("s1", "b", H[1]), ("s1", "c", H[0])], "collision"),
    ([("s1", "a", H[0]), ("s1", "b", H[1]), ("s1", "c", H[2], 1, "s1/a.txt")], "collision"),
    ([("s1", "a", H[0]), ("s1", "c", H[2])], "unexpected role"),
])
def test_a_snapshot_is_refused_as_a_whole(spark, log, rows, refused):
    out, number = registry.register(log, snaps(spark, "s1", "s2"), files(spark, *rows, ("s2", "x", H[5])))
    got = result(out)
    assert all(r for (s, _), (_, r) in got.items() if s == "s1") and got["s2", "x"] == ("new", False)
    assert refused == "unexpected role" or refused in {v for v, _ in got.values()}
    assert number == 2 and log.read("files").where("snapshot_id = 's1'").count() == 2


def test_other_metadata_refuse(spark, log):
    out, number = registry.register(log, snaps(spark, "s1", description=None), files(spark, ("s1", "a", H[0]), ("s1", "b", H[1]), ("s1", "c", H[2])))
    assert number is None and set(result(out).values()) == {("verified", True), ("new", True)}


def test_request_that_collides_with_itself(spark, log):
    out, _ = registry.register(log, snaps(spark, "s2", "s3"), files(spark, ("s2", "x", H[5]), ("s3", "x", H[5]), ("s2", "x", H[5])))
    got = result(out)
    assert got["s2", "x"] == ("new", False) and got["s3", "x"] == ("collision", True)
    assert log.read("files").where("snapshot_id = 's2'").count() == 1
    assert [r.snapshot_id for r in log.read("snapshots").where("commit = 2").collect()] == ["s2"]


def test_files_without_their_snapshot(spark, log):
    out, number = registry.register(log, snaps(spark, "s2"), files(spark, ("s9", "x", H[5])))
    assert result(out) == {("s9", "x"): ("new", True)} and number is None


def test_two_writers_at_once(spark, log):
    """The same request from four sides: one commit, the others find everything verified; and a file that two snapshots want goes to one."""
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda s: registry.register(log, snaps(spark, s), files(spark, (s, "x", H[6]))), ["s5", "s5", "s6", "s6"]))
    stored = log.read("files").where(f"sha256 = '{H[6]}'").collect()
    assert len(stored) == 1 and sum(n is not None for _, n in got) == 1
    winner = stored[0].snapshot_id
    for s, (out, n) in zip(["s5", "s5", "s6", "s6"], got, strict=True):
        status = result(out)[s, "x"]
        assert status == (("new", False) if n is not None else ("verified", False) if s == winner else ("collision", True))


def test_filters_reach_the_stored_table(spark, log):
    plan = log.read("files").where(f"sha256 = '{H[0]}'").select("role")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sha256," in plan
