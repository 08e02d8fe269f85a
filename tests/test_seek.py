"""Probes and prefix reads against plain reads of the whole text."""

import random

import pytest

from intakeyard.sources import seek

FRACTIONS = ("0.00", "0.25", "0.50", "0.75", "0.99")


def write(tmp_path, *texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, t in enumerate(texts):
        (folder / f"part-{k:03d}.txt").write_bytes(t.encode())
    (folder / "_SUCCESS").write_text("")
    return str(folder)


def brute(texts, fraction):
    data = "".join(texts).encode()
    offset = int(len(data) * float(fraction))
    start = 0 if offset == 0 else data.find(b"\n", offset) + 1
    if (offset and start == 0) or start >= len(data):
        return None
    end = data.find(b"\n", start)
    return start, data[start:end if end >= 0 else len(data)].decode()


@pytest.mark.parametrize("read", [1 << 16, 7])
def test_probes(spark, tmp_path, monkeypatch, read):
    monkeypatch.setattr(seek, "READ", read)
    rng = random.Random(read)
    texts = ["".join("x" * rng.randrange(0, 60) + "é\n" for _ in range(rng.randrange(1, 30))) for _ in range(5)]
    texts[3] = ""
    got = {r.fraction: (r.line_offset, r.value) for r in seek.probe_lines(spark, write(tmp_path, *texts), FRACTIONS).collect()}
    want = {f: brute(texts, f) for f in FRACTIONS}
    assert got == {f: w for f, w in want.items() if w}


def test_bytes_read_do_not_grow(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    small = write(tmp_path / "a", "y" * 99 + "\n" + ("x" * 99 + "\n") * 5_000)
    large = write(tmp_path / "b", "y" * 99 + "\n" + ("x" * 99 + "\n") * 100_000)
    reads = [sum(r.bytes_read for r in seek.probe_lines(spark, p, FRACTIONS).collect()) for p in (small, large)]
    assert max(reads) <= 10 * seek.READ  # a seek and a line each, in half a megabyte and in ten


def test_probes_of_edges(spark, tmp_path):
    for k, (text, want) in enumerate([("", []), ("one", [(0, "one")]), ("one\n", [(0, "one")]), ("a\nb", [(0, "a"), (2, "b")])]):
        (tmp_path / str(k)).mkdir()
        got = seek.probe_lines(spark, write(tmp_path / str(k), text), ("0.00", "0.5")).collect()
        assert sorted((r.line_offset, r.value) for r in got) == want


@pytest.mark.parametrize("size", [16, 100, 1 << 20])
def test_first_lines(spark, tmp_path, size):
    rng = random.Random(size)
    texts = ["".join("x" * rng.randrange(0, 40) + f"é{k}\n" for k in range(rng.randrange(1, 25))) for _ in range(4)] + ["last without end"]
    lines = "".join(texts).split("\n")
    path = write(tmp_path, *texts)
    for n in (1, 7, len(lines), len(lines) + 50):
        got = sorted((r.line_no, r.value) for r in seek.first_lines(spark, path, n, size).collect())
        assert got == list(enumerate(lines[:n], 1))
    assert seek.first_lines(spark, path, 0).count() == 0


def test_only_the_first_ranges_are_planned(spark, tmp_path):
    path = write(tmp_path, *["abcdefg\n" * 100 for _ in range(20)])
    assert len(seek.ranges(spark, path, 3, 80)) == 1
    assert len(seek.ranges(spark, path, 25, 80)) == 3  # ten lines a range
