"""Reads that touch only a few bytes or the first records of a file, however large it is.

A folder is one logical file in name order. ``probe_lines`` seeks to byte offsets, drops the line that the offset cuts and
returns the next one. ``first_lines`` returns the first ``n`` lines: byte ranges are read in order, a few at first and
then more at a time, until they hold enough, and nothing behind them is opened. Both read in tasks, one range or probe each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intakeyard.session import ship_package
from intakeyard.sources import files

#: Bytes of a range and of one read.
RANGE, READ = 32 << 20, 64 << 10
_SCHEMA = "path string, start bigint, end bigint"


def parts(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of the files with content, in name order."""
    return [(p, n) for p, n in files.sizes(spark, path) if n > 0]


def _open(path: str):
    import pyarrow.fs as pafs

    from intakeyard.operators.artifacts import arrow_uri

    fs, place = pafs.FileSystem.from_uri(arrow_uri(path))
    return fs.open_input_file(place)


def _line_at(f, at: int) -> tuple[bytes, int, int]:
    """The bytes from ``at`` to the next line end, where the next line starts, and how many bytes were read."""
    out, read = [], 0
    while True:
        f.seek(at + read)
        chunk = f.read(READ)
        read += len(chunk)
        cut = chunk.find(b"\n")
        if cut >= 0:
            out.append(chunk[:cut])
            line = b"".join(out)
            return line, at + len(line) + 1, read
        out.append(chunk)
        if not chunk:
            line = b"".join(out)
            return line, at + len(line), read


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for fraction, path, at, begin, following in pdf[["fraction", "path", "at", "begin", "following"]].itertuples(index=False):
            with _open(path) as f:
                read, start = 0, at
                if begin + at > 0:
                    _, start, read = _line_at(f, at)
                line, after, more = _line_at(f, start)
                read += more
            if after == start and isinstance(following, str):  # the cut line was the file's last
                with _open(following) as f:
                    line, after, more = _line_at(f, 0)
                    begin, start, read = begin + start, 0, read + more
            if after > start:
                rows.append((fraction, begin + at if start else at, begin + start, line.decode("utf-8", "replace"), read))
        yield pd.DataFrame([(f, o, v, r) for f, _, o, v, r in rows], columns=["fraction", "line_offset", "value", "bytes_read"])


def probe_lines(spark: SparkSession, path: str, fractions: tuple[str, ...]) -> DataFrame:
    """``(fraction, line_offset, value, bytes_read)``: the first whole line behind each fraction of the bytes.

    The line at offset 0 is whole; a fraction behind the last line start gives no row."""
    ship_package(spark)
    listed = parts(spark, path)
    total, rows = sum(n for _, n in listed), []
    for f in fractions:
        offset, begin = int(total * float(f)), 0
        for k, (p, n) in enumerate(listed):
            if offset < begin + n:
                rows.append((f, p, offset - begin, begin, listed[k + 1][0] if k + 1 < len(listed) else None))
                break
            begin += n
    schema = "fraction string, path string, at bigint, begin bigint, following string"
    return (spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))
            .mapInPandas(_probe, "fraction string, line_offset bigint, value string, bytes_read bigint"))


def _lines_of(path: str, start: int, end: int, limit: int) -> Iterator[str]:
    """Lines that start in ``[start, end)``, ``limit`` at most."""
    with _open(path) as f:
        size = f.size()
        at = start
        if start > 0:
            f.seek(start - 1)
            if f.read(1) != b"\n":
                _, at, _ = _line_at(f, start)
        f.seek(at)
        rest, done = b"", 0
        while at < min(end, size) and done < limit:
            chunk = f.read(1 << 20)
            if not chunk:
                yield rest.decode("utf-8", "replace")
                return
            *lines, rest = (rest + chunk).split(b"\n")
            for line in lines:
                if at >= end or done == limit:
                    return
                yield line.decode("utf-8", "replace")
                at, done = at + len(line) + 1, done + 1


def _count(limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"k": pdf["k"], "n": [sum(1 for _ in _lines_of(p, int(s), int(e), limit)) for p, s, e in
                                                     zip(pdf["path"], pdf["start"], pdf["end"], strict=True)]})
    return run


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for p, s, e, before, want in pdf[["path", "start", "end", "before", "want"]].itertuples(index=False):
            block: list[str] = []
            for line in _lines_of(p, int(s), int(e), int(want)):
                block.append(line)
                if len(block) == 4096:
                    yield pd.DataFrame({"line_no": range(before + 1, before + 1 + len(block)), "value": block})
                    before, block = before + len(block), []
            if block:
                yield pd.DataFrame({"line_no": range(before + 1, before + 1 + len(block)), "value": block})


def ranges(spark: SparkSession, path: str, n: int, size: int = RANGE) -> list[tuple[str, int, int, int, int]]:
    """``(path, start, end, lines before, lines wanted)`` of the byte ranges that hold the first ``n`` lines.

    Ranges are counted in waves that grow fourfold; a count stops at what is still wanted."""
    ship_package(spark)
    todo = [(p, s, min(s + size, total)) for p, total in parts(spark, path) for s in range(0, total, size)]
    out, have, wave = [], 0, 1
    while todo and have < n:
        now, todo = todo[:wave], todo[wave:]
        df = spark.createDataFrame([(k, *r) for k, r in enumerate(now)], f"k int, {_SCHEMA}").repartition(len(now), "k")
        counts = {r["k"]: r["n"] for r in df.mapInPandas(_count(n - have), "k int, n bigint").collect()}  # one number a range
        for k, r in enumerate(now):
            if have < n and counts[k]:
                out.append((*r, have, min(counts[k], n - have)))
                have += counts[k]
        wave *= 4
    return out


def first_lines(spark: SparkSession, path: str, n: int, size: int = RANGE) -> DataFrame:
    """``(line_no, value)`` of the first ``n`` lines of a file or folder."""
    found = ranges(spark, path, n, size)
    if not found:
        return spark.createDataFrame([], "line_no bigint, value string")
    df = spark.createDataFrame(found, f"{_SCHEMA}, before bigint, want bigint").repartition(len(found))
    return df.mapInPandas(_read, "line_no bigint, value string").select(F.col("line_no"), "value")
