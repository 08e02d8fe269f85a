"""CSV records by the quoting rules of Python's ``csv`` module, from files that split.

A record may span lines, so whether a line starts inside a quoted cell depends on all lines before it. A line
either leaves that state as it is, turns it, or ends in a fixed state; two regexes tell which (lines without a quote need
none). A first narrow pass sends these flags, not the texts, through one task per scan split, which gives the state after the
split and the records begun in it for either state before it; a window over one row per split tells the true states and
numbers. In a second narrow pass each split numbers its own lines and joins those of a record. Only records that lie in
several splits are left: the splits that they touch are read once more, and one piece per record and split is
shuffled by record number.

Rules: a quote opens a quoted cell only at the cell's start; inside, two quotes are one and (vendor dialect) a
backslash takes the next character literally; text after the closing quote belongs to the cell; outside
quotes a backslash also takes the next character literally. Records without any character are skipped and not numbered.
A record of more than ``max_record`` bytes (a quote that never closes makes one of the rest of its file) is numbered and named
in ``error``, without its text: pieces above that size never leave their split, so no task gathers more than a few of them.
A folder is one logical file in name order; each of its files holds whole records. A line end (``\n`` or
``\r\n``) outside quotes ends the record, an escaped one too. All regex loops are possessive, hence linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from intakeyard.session import ship_package
from intakeyard.sources import seek
from intakeyard.sources.positions import BROADCAST_LIMIT_BYTES, SEGMENT_BYTES, segment_bound

#: Largest record returned, in bytes of UTF-8.
MAX_RECORD = 16 << 20


@dataclass(frozen=True)
class Dialect:
    """Comma and double quote; ``escape`` adds the vendor's backslash."""

    escape: bool

    @property
    def body(self) -> str:
        return r'(?:[^"\\]++|\\(?s:.)|"")*+' if self.escape else r'(?:[^"]++|"")*+'

    @property
    def rest(self) -> str:
        return r"(?:[^,\\]++|\\(?s:.))*+\\?+" if self.escape else r"[^,]*+"

    @property
    def closed(self) -> str:
        return f'"{self.body}"(?:[^,]{self.rest})?+|(?!"){self.rest}'

    @property
    def unclosed(self) -> str:
        return f'"{self.body}' + r"\\?+\z"

    def stays_open(self, line: Column) -> Column:
        """A line that starts outside quotes ends inside them."""
        return line.rlike(rf"\A(?:(?:{self.closed}),)*+{self.unclosed}")

    def cells(self, record: Column) -> Column:
        raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({self.unclosed}|{self.closed})"), F.lit(1))
        return F.transform(raw, self._value)

    def _plain(self, text: Column) -> Column:
        return F.regexp_replace(text, r"\\((?s:.))", "$1") if self.escape else text

    def _value(self, raw: Column) -> Column:
        body = F.regexp_extract(raw, rf'\A"({self.body})', 1)
        tail = F.substr(raw, F.length(body) + 3)  # behind the closing quote: one literal character, then plain text
        inside = F.regexp_replace(body, r'\\((?s:.))|"(")', "$1$2") if self.escape else F.replace(body, F.lit('""'), F.lit('"'))
        quoted = F.concat(inside, F.substr(tail, F.lit(1), F.lit(1)), self._plain(F.substr(tail, F.lit(2))))
        return F.when(raw.startswith('"'), quoted).when(raw.contains("\\"), self._plain(raw)).otherwise(raw)


VENDOR, DEFAULT = Dialect(True), Dialect(False)


def _with_state(df: DataFrame, out0: str, out1: str, by: list[str], order: list[str]) -> DataFrame:
    """Adds ``_s0`` and ``_s1``: the state (1: inside quotes) before each row if the group starts in 0 or in 1.

    ``out0`` and ``out1`` hold the state after a row that starts in 0 or in 1.
    """
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    turn = F.when((F.col(out0) == 1) & (F.col(out1) == 0), 1).otherwise(0)
    df = df.select("*", F.coalesce(F.sum(turn).over(before), F.lit(0)).alias("_turns"))
    fixed = F.when(F.col(out0) == F.col(out1), (F.col(out0) + F.col("_turns")) % 2)  # as if all turns so far still came
    df = df.select("*", F.last(fixed, ignorenulls=True).over(before).alias("_fixed"))
    return df.select("*", *[((F.coalesce("_fixed", F.lit(s)) + F.col("_turns")) % 2).alias(f"_s{s}") for s in (0, 1)]).drop("_turns", "_fixed")


def _before(o0: np.ndarray, o1: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The state before each line, and after the last, if the first starts in ``state``."""
    turns = np.concatenate([[0], np.cumsum((o0 == 1) & (o1 == 0))])
    fixed = np.concatenate([[-1], np.where(o0 == o1, np.arange(len(o0)), -1)])
    last = np.maximum.accumulate(fixed)  # the last line so far that ends in a fixed state
    known = np.where(last >= 0, o0[np.maximum(last, 0)] if len(o0) else 0, state)
    out = (known + turns - np.where(last >= 0, turns[last + 1], 0)) % 2
    return out[:-1], int(out[-1])


def _runs(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of rows with equal keys."""
    n = len(keys[0])
    if n:
        cut = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        yield from zip([0, *cut.tolist()], [*cut.tolist(), n], strict=True)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(_f, _b, _a0, _a1, _n0, _n1)`` per split: state after it and records begun in it, if it starts outside or inside quotes."""
    now, out = None, []
    for batch in batches:
        split, b, o0, o1, blank = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6))
        for s, e in _runs(split):
            if now is None or now[0] != split[s]:
                out += [now] if now else []
                now = [split[s], batch.column(0)[s].as_py(), b[s], 0, 1, 0, 0]
            for k in (0, 1):
                before, now[3 + k] = _before(o0[s:e], o1[s:e], now[3 + k])
                now[5 + k] += int(((before == 0) & ~blank[s:e]).sum())
    out += [now] if now else []
    names = ["_f", "_b", "_a0", "_a1", "_n0", "_n1"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i + 1] for r in out], t) for i, t in enumerate(kinds)], names=names)


_ROW = pa.schema([("pos", pa.int64()), ("_b", pa.int64()), ("size", pa.int64()), ("value", pa.string())])


def _numbered(limit: int, crossing: bool):
    """``(pos, _b, size, value)``: the records that begin and end in this split, or (``crossing``) its pieces of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, begun = None, 0, 0
        piece = None  # of a record over several lines: number, split start, size, texts, whether it begins here

        def piece_row() -> tuple:
            return (*piece[:3], "\n".join(piece[3]) if piece[2] <= limit else None)

        for batch in batches:
            value, split_of = batch.column(0), batch.column(1).to_numpy()
            b, o0, o1, blank, inside, off = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 8))
            size = pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64)
            for s, e in _runs(split_of):
                found = []
                if split != split_of[s]:
                    if piece and crossing:
                        found.append(piece_row())
                    split, state, begun, piece = split_of[s], int(inside[s]), int(off[s]), None
                before, state = _before(o0[s:e], o1[s:e], state)
                after = np.concatenate([before[1:], [state]])
                starts = (before == 0) & ~blank[s:e]
                pos = begun + np.cumsum(starts)
                begun = int(pos[-1])
                for i in np.flatnonzero((before == 1) | (after == 1)).tolist():
                    n = int(size[s + i])
                    if piece is None:
                        piece = [int(pos[i]), int(b[s]), n, [], before[i] == 0]
                    else:
                        piece[2] += n + 1
                    if piece[2] <= limit:
                        piece[3].append(value[s + i].as_py())
                    else:
                        piece[3].clear()
                    if after[i] == 0:
                        if piece[4] != crossing:
                            found.append(piece_row())
                        piece = None
                at = np.flatnonzero(starts & (after == 0))
                if len(at) and not crossing:
                    texts = pc.if_else(pa.array(size[at + s] <= limit), value.take(pa.array(at + s)), pa.scalar(None, pa.string()))
                    yield pa.RecordBatch.from_arrays([pa.array(pos[at], pa.int64()), pa.array(b[at + s], pa.int64()), pa.array(size[at + s]), texts], schema=_ROW)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), _ROW.types, strict=True)], schema=_ROW)
        if piece and crossing:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(piece_row(), _ROW.types, strict=True)], schema=_ROW)

    return run


def _flagged(text: DataFrame, dialect: Dialect) -> DataFrame:
    """What a line does to the state, as ``_o0`` and ``_o1``: the state after it if it starts outside or inside quotes."""
    quoted = F.col("value").contains('"')
    return text.select("*", F.when(quoted, dialect.stays_open(F.col("value"))).otherwise(False).cast("int").alias("_o0"),
                       F.when(quoted, dialect.stays_open(F.concat(F.lit('"'), "value"))).otherwise(True).cast("int").alias("_o1"),
                       F.col("value").isin("", "\r").alias("_blank"))


def split_states(text: DataFrame, dialect: Dialect) -> DataFrame:
    """``(_f, _b, _in, _out, _off)`` per scan split: the state before and after it, and how many records begin before it."""
    found = _flagged(text, dialect).select("_f", "_split", "_b", "_o0", "_o1", "_blank").mapInArrow(
        _summaries, "_f string, _b bigint, _a0 int, _a1 int, _n0 bigint, _n1 bigint")
    found = _with_state(found, "_a0", "_a1", ["_f"], ["_b"])
    n, out = (F.when(F.col("_s0") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("_n", "_a"))
    ahead = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    return found.select("_f", "_b", F.col("_s0").cast("int").alias("_in"), out.alias("_out"),
                        F.coalesce(F.sum(n).over(ahead), F.lit(0)).cast("bigint").alias("_off"))


def records(spark: SparkSession, path: str, dialect: Dialect, max_record: int = MAX_RECORD) -> DataFrame:
    """``(pos, record, error)``: numbered raw records, the header included as record 1; ``error`` names one that is too long."""
    text = spark.read.option("lineSep", "\n").text(path)
    few = segment_bound(text) * SEGMENT_BYTES <= BROADCAST_LIMIT_BYTES
    return _records(text.select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                                F.monotonically_increasing_id().alias("_m")), dialect, max_record, few)


def first_records(spark: SparkSession, path: str, dialect: Dialect, n: int, max_record: int = MAX_RECORD) -> DataFrame:
    """The first ``n`` of ``records``, reading the first lines of the file only: as many as the records need, and at most
    four times as many again. ``n`` is what one task may hold."""
    lines = n + 8
    while True:
        text = seek.first_lines(spark, path, lines).select("value", F.lit(path).alias("_f"), F.lit(0).cast("bigint").alias("_b"), F.col("line_no").alias("_m"))
        found = _records(text.coalesce(1).sortWithinPartitions("_m"), dialect, max_record, True).where(F.col("pos") <= n + 1)
        held = text.count()
        if held < lines:  # that is all there is
            return found.where(F.col("pos") <= n)
        if found.agg(F.max("pos")).first()[0] == n + 1:  # the next record has begun, so these are whole
            return found.where(F.col("pos") <= n)
        lines *= 4


def _records(text: DataFrame, dialect: Dialect, max_record: int, few: bool) -> DataFrame:
    """Records of lines ``(value, _f, _b, _m)``, in order within each task; ``few`` splits may be sent to all tasks."""
    ship_package(text.sparkSession)
    text = text.select("*", F.xxhash64("_f", "_b").alias("_split"))
    splits = split_states(text, dialect)

    def located(some: DataFrame) -> DataFrame:
        if few:
            return text.join(F.broadcast(some), ["_f", "_b"])  # keeps the order of lines
        return text.join(some, ["_f", "_b"]).sortWithinPartitions("_f", "_b", "_m")

    def numbered(lines: DataFrame, crossing: bool) -> DataFrame:
        return _flagged(lines, dialect).select("value", "_split", "_b", "_o0", "_o1", "_blank", "_in", "_off").mapInArrow(
            _numbered(max_record, crossing), "pos bigint, _b bigint, size bigint, value string")

    # if no split is entered or left inside quotes, this side is found empty and its lines are not read at all
    pieces = (numbered(located(splits.where("_in = 1 OR _out = 1")), True).groupBy("pos")
              .agg((F.sum("size") + F.count(F.lit(1)) - 1).alias("size"), F.array_sort(F.collect_list(F.struct("_b", "value"))).alias("l")))
    fits = (F.col("size") <= max_record) & F.forall("l", lambda x: x["value"].isNotNull())
    crossed = pieces.select("pos", "size", F.when(fits, F.array_join(F.transform("l", lambda x: x["value"]), "\n")).alias("record"))
    # a record ends with a line end outside quotes; only one that ends with its file may still be open
    ended = F.col("record").endswith("\r") & ~dialect.stays_open(F.col("record"))
    crossed = crossed.select("pos", "size", F.when(ended, _without_end()).otherwise(F.col("record")).alias("record"))
    inner = numbered(located(splits), False).select("pos", "size", F.col("value").alias("record")).select("pos", "size", _without_end().alias("record"))
    error = F.when(F.col("record").isNull(), F.concat(F.lit("record of "), F.col("size").cast("string"), F.lit(f" bytes, over {max_record}")))
    return inner.union(crossed).select("pos", "record", error.alias("error"))


def _without_end() -> Column:
    return F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...], dialect: Dialect, max_record: int = MAX_RECORD,
             with_errors: bool = False, first: int | None = None) -> DataFrame:
    """``(pos, *columns, n_cells[, error])`` of the data records, numbered from 1; missing cells are null, surplus ones count.
    A record that is too long has null cells, no count of them, and an ``error``. ``first`` reads so many records only."""
    found = records(spark, path, dialect, max_record) if first is None else first_records(spark, path, dialect, first + 1, max_record)
    cells = found.where("pos > 1").select((F.col("pos") - 1).alias("pos"), dialect.cells(F.col("record")).alias("c"), "error")
    return cells.select("pos", *[F.get("c", F.lit(i)).alias(c) for i, c in enumerate(columns)],
                        F.when(F.col("c").isNotNull(), F.size("c")).alias("n_cells"), *(["error"] if with_errors else []))


def header(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame:
    """One row ``(cells)`` with the cells of the first record, from the first lines; no row for a file without records."""
    return first_records(spark, path, dialect, 1).select(dialect.cells(F.col("record")).alias("cells"))
