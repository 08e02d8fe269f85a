"""Removal of repeated byte strings by a distributed sort of suffixes.

A byte goes if it lies in a string of ``width`` bytes that also starts somewhere else. Sorting
every suffix of the corpus would move hundreds of bytes for each byte of input, so suffixes
are first thinned by an exact rule:

1. Every window of ``width`` bytes has an *anchor*: its ``core`` bytes with the smallest
   hash, leftmost first. Equal windows have equal anchors at equal offsets. The windows of a text
   fall into runs that share an anchor position (one run per ~100 bytes). Two grouped counts
   tell the runs whose anchor occurs nowhere else (nothing to do), whose whole run content
   occurs again (every byte repeated) and the rest, ``mixed``: the anchor recurs but the run doesn't.
2. Only the suffixes that start in mixed runs are sorted. A suffix's leading tokens are its anchor's hash and the anchor's
   distance; its further tokens are its bytes, eight at a time. Splitters sampled from the leading tokens, runs that occur often
   more likely, range-partition the suffixes; each bucket is sorted by a multikey quicksort: by the leading tokens, then ranges
   still equal by the next token in which they differ, until a range is equal in ``width`` bytes, which are then repeated.
   An anchor that a third of all texts share spreads over as many buckets as it has distances, and suffixes that are equal
   have equal leading tokens, so they never part at a splitter and none is missed at a boundary. Neighbouring suffixes of a text
   travel as the bytes they cover. Before the shuffle each task sorts its own suffixes a block at a time; of those that are equal
   one travels on, and the spans of all are known, so a passage in very many texts arrives a few times only.
3. Spans go back to their texts by one join; the text shuffle of step 2 is reused.

Whole runs are told apart by a cryptographic digest (64 bits, beside the anchor's hash), suffixes of mixed runs by their bytes. A
collision of anchor hashes only makes a run mixed. Texts above ``CHUNK`` bytes are read in pieces that overlap by ``width``.

Defined results: null and empty texts have no bytes and no spans; texts under ``width`` bytes lose
nothing; repeated rows are different documents, so each copy of ``width`` bytes or more is removed
whole; null ids stay apart by their text; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intakeyard.llm.common import documents, saved, shuffle_partitions
from intakeyard.llm.textbytes import RangeHash, blocks_of, mix, text_views
from intakeyard.session import ship_package

CHUNK = 1 << 20
_PLACE = np.uint64(CHUNK * 2 - 1)
#: Low bits of a leading token hold the anchor's distance; a window is at most so wide.
_LOW = np.uint64(2**16 - 1)
#: Suffixes that a task sorts at a time before the shuffle.
BLOCK = 200_000


def anchor_runs(data: np.ndarray, width: int, core: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(anchor hash, run digest, first window, last window, anchor's distance from the first)`` arrays, piece by piece of a text."""
    span = width - core + 1
    for base in range(0, max(0, len(data) - width + 1), CHUNK):
        part = data[base:base + CHUNK + width - 1]
        n = len(part) - width + 1
        h = RangeHash(part).of_width(core)
        packed = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)  # smallest hash, then leftmost
        rows = -(-len(h) // span)
        padded = np.full(rows * span, np.uint64(2**64 - 1))
        padded[:len(h)] = packed
        block = padded.reshape(rows, span)
        ahead = np.minimum.accumulate(block, axis=1).ravel()
        behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:n], ahead[span - 1:span - 1 + n]) & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        last = np.concatenate([first[1:] - 1, [n - 1]])
        at = at[first]
        raw = memoryview(np.ascontiguousarray(part))
        run = np.array([int.from_bytes(hashlib.blake2b(raw[i:j + width], digest_size=8).digest(), "little")
                        for i, j in zip(first.tolist(), last.tolist(), strict=True)], np.uint64)
        yield h[at], run ^ mix((at - first).astype(np.uint64)), first + base, last + base, at - first


def _anchors(width: int, core: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            size = 0
            for i, view in enumerate(text_views(batch.column(2))):
                for g, r, lo, hi, off in anchor_runs(view, width, core):
                    for store, value in zip(out, (g.view(np.int64), r.view(np.int64), np.full(len(g), k1[i]),
                                                  np.full(len(g), k2[i], np.int32), (lo << 32) | ((hi - lo) << 16) | off), strict=True):
                        store.append(value)
                    size += len(g)
                if size > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["g", "r", "k1", "k2", "pos"])
                    out, size = [[], [], [], [], []], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["g", "r", "k1", "k2", "pos"])

    return run


def multikey_sort(*tokens: np.ndarray) -> np.ndarray:
    """Order of the rows by their token sequences: a multikey quicksort, all equal ranges of a token at a time.

    Rows are sorted by the first token; only ranges that are still equal are sorted on by the next one.
    """
    order = np.argsort(tokens[0], kind="stable")  # of equal rows the first one leads, so neighbours stay together
    for depth in range(1, len(tokens)):
        before = tokens[depth - 1][order]
        equal = np.concatenate([[False], before[1:] == before[:-1]])
        if depth > 1:
            equal &= group_equal
        group_equal = equal
        group = np.cumsum(~equal)
        tied = equal | np.concatenate([equal[1:], [False]])
        at = np.flatnonzero(tied)
        if len(at) == 0:
            break
        order[at] = order[at][np.lexsort((tokens[depth][order[at]], group[at]))]
    return order


class Suffixes:
    """Windows of ``width`` bytes in one buffer, with their leading tokens."""

    def __init__(self, g: np.ndarray, off: np.ndarray, at: np.ndarray, data: np.ndarray, width: int):
        self.g, self.off, self.at = g, off, at
        size = 8 if width >= 8 else 1  # bytes of a token
        self.tokens = np.ndarray((max(0, len(data) - size + 1),), ">u8" if size == 8 else np.uint8, data, strides=(1,))
        self.words = self.tokens.view(np.uint64) if size == 8 else self.tokens  # for equality, in the machine's byte order
        self.depths = [*range(0, width - size + 1, size), *([width - size] if width % size else [])]

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Which windows have an equal one, and which are the first of their equals in the sort."""
        n = len(self.g)
        again, leads = np.zeros(n, bool), np.ones(n, bool)
        lead = (self.g & ~_LOW) | self.off  # as the splitters cut; the bytes tell apart what the low bits of g would
        order = multikey_sort(lead)
        new = np.ones(n, bool)
        new[1:] = lead[order[1:]] != lead[order[:-1]]
        rows, group = self._tied(order, np.cumsum(new))
        while len(rows):
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.append(starts, len(rows)))
            depth = self._first_difference(rows, rows[np.repeat(starts, sizes)])
            least = np.repeat(np.minimum.reduceat(depth, starts), sizes)
            equal = least == len(self.depths)
            again[rows[equal]] = True
            leads[rows[equal]] = False
            leads[rows[starts[equal[starts]]]] = True
            rows, group, least = rows[~equal], group[~equal], least[~equal]
            token = self.tokens[self.at[rows] + np.array([*self.depths, 0])[least]]  # the first in which the range differs
            order = np.lexsort((token, group))
            rows, group, token = rows[order], group[order], token[order]
            new = np.ones(len(rows), bool)
            new[1:] = (group[1:] != group[:-1]) | (token[1:] != token[:-1])
            rows, group = self._tied(rows, np.cumsum(new))
        return again, leads

    @staticmethod
    def _tied(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are not alone in their range."""
        many = np.bincount(group)[group] > 1 if len(rows) else np.zeros(0, bool)
        return rows[many], group[many]

    def _first_difference(self, rows: np.ndarray, leader: np.ndarray) -> np.ndarray:
        """The number of equal tokens each row begins with, compared with its leader."""
        out = np.full(len(rows), len(self.depths))
        open_ = np.flatnonzero(rows != leader)
        a, b = self.at[rows[open_]], self.at[leader[open_]]
        for k, d in enumerate(self.depths):
            differ = self.words[a + d] != self.words[b + d]
            if differ.any():
                out[open_[differ]] = k
                open_, a, b = open_[~differ], a[~differ], b[~differ]
            if len(open_) == 0:
                break
        return out


_PIECE = "bucket int, k1 bigint, k2 int, g bigint, off int, lo int, n int, data binary, spans binary"
_PIECE_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _suffixes(width: int, splitters: np.ndarray):
    """Suffixes of the mixed runs as pieces of neighbours ``(bucket, text, anchor, distance, start, number, bytes)``; suffixes
    already known to be repeated come as ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, runs = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(4)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(runs.offsets)))
            flat = runs.flatten()
            g, pos = flat.field("g").to_numpy(), flat.field("pos").to_numpy()
            views = list(text_views(batch.column(3)))
            for s, e in blocks_of((((pos >> 16) & 0xFFFF) + 1).tolist(), BLOCK):
                yield _pieces(views, k1, k2, doc[s:e], g[s:e], pos[s:e], width, splitters)

    return run


def _pieces(views, k1, k2, doc, g, pos, width, splitters) -> pa.RecordBatch:
    lo, n, off = pos >> 32, ((pos >> 16) & 0xFFFF) + 1, pos & 0xFFFF
    data = np.concatenate([views[d][a:a + m + width - 1] for d, a, m in zip(doc.tolist(), lo.tolist(), n.tolist(), strict=True)])
    base = np.cumsum(n + width - 1) - (n + width - 1)
    run = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    lead = Suffixes(g.view(np.uint64)[run], (off[run] - i).astype(np.uint64), base[run] + i, data, width)
    again, first = lead.repeated()
    out: list[tuple] = []
    known = np.flatnonzero(again)
    if len(known):
        of, start = doc[run[known]], lo[run[known]] + i[known]
        order = np.lexsort((start, of))
        of, start = of[order], start[order]
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        for a, b in zip(cuts, np.append(cuts[1:], len(of)), strict=True):
            spans = np.array(merged(start[a:b], start[a:b] + width), np.int32)
            key = int(k1[of[a]])
            out.append((-1 - key % 4096, key, int(k2[of[a]]), None, None, None, None, None, spans.tobytes()))
    at = np.flatnonzero(first)
    bucket = np.searchsorted(splitters, (lead.g[at] & ~_LOW) | lead.off[at], "right")
    new = np.ones(len(at), bool)
    new[1:] = (run[at[1:]] != run[at[:-1]]) | (i[at[1:]] != i[at[:-1]] + 1) | (bucket[1:] != bucket[:-1])
    cuts = np.flatnonzero(new)
    raw = memoryview(data)
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(at)).tolist(), strict=True):
        w, r = at[a], run[at[a]]
        p = int(lead.at[w])
        out.append((int(bucket[a]), int(k1[doc[r]]), int(k2[doc[r]]), int(g[r]), int(lead.off[w]), int(lo[r] + i[w]), b - a,
                    bytes(raw[p:p + (b - a) + width - 1]), None))
    cols = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE_TYPES, strict=True)], names=[c.split()[0] for c in _PIECE.split(", ")])


_SPAN = pa.schema([("k1", pa.int64()), ("k2", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])


def _sort_bucket(width: int):
    """Spans of repeated suffixes; the pieces come in order of their buckets, and one bucket is held at a time."""

    def spans_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        known = table.filter(table.column("data").is_null())
        if len(known):
            pairs = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in known.column("spans").to_pylist()]
            each = np.repeat(np.arange(len(pairs)), [len(x) for x in pairs])
            both = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(known.column("k1").to_numpy()[each]), pa.array(known.column("k2").to_numpy()[each]),
                                              pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], schema=_SPAN)
        table = table.filter(table.column("data").is_valid())
        if len(table) == 0:
            return
        n, lo, off, g = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "lo", "off", "g"))
        data = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
        base = np.cumsum(n + width - 1) - (n + width - 1)
        piece = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
        again, _ = Suffixes(g.view(np.uint64)[piece], (off[piece] - i).astype(np.uint64), base[piece] + i, data, width).repeated()
        at = np.flatnonzero(again)
        if len(at) == 0:
            return
        new = np.ones(len(at), bool)
        new[1:] = (piece[at[1:]] != piece[at[:-1]]) | (at[1:] != at[:-1] + 1)
        a = at[new]
        b = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
        of = piece[a]
        yield pa.RecordBatch.from_arrays([pa.array(table.column("k1").to_numpy()[of]), pa.array(table.column("k2").to_numpy()[of]),
                                          pa.array((lo[of] + i[a]).astype(np.int32)), pa.array((lo[of] + i[b] + width).astype(np.int32))], schema=_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    if held and bucket[a] != now:
                        yield from spans_of(pa.Table.from_batches(held))
                        held = []
                    now = bucket[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from spans_of(pa.Table.from_batches(held))

    return run


def merged(s: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the half-open spans, in order."""
    if len(s) == 0:
        return []
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    at = np.flatnonzero(new)
    return list(zip(s[at].tolist(), e[np.concatenate([at[1:] - 1, [len(s) - 1]])].tolist(), strict=True))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column(2).to_pylist()
        out = []
        for view, found in zip(text_views(batch.column(1)), spans, strict=True):
            runs = merged(*np.array([(x["s"], x["e"]) for x in found], np.int64).T) if found else []
            keep, at = hashlib.sha256(), 0
            for s, e in runs:
                keep.update(view[at:s])
                at = e
            keep.update(view[at:])
            out.append((len(view), sum(e - s for s, e in runs), len(runs), keep.hexdigest()))
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(rows: DataFrame, width: int, core: int) -> DataFrame:
    """``(k1, k2, spans)``: half-open byte spans (they may overlap) to remove, per text key, of ``(k1, k2, id, text)``."""
    # kept in the shared folder: hashing all windows costs more than to write and read a row for each hundred of them
    anchors = saved(rows.select("k1", "k2", "text").mapInArrow(_anchors(width, core), "g bigint, r bigint, k1 bigint, k2 int, pos bigint"))
    runs = anchors.groupBy("g", "r").agg(F.count(F.lit(1)).alias("c"))
    shared = runs.groupBy("g").agg(F.sum("c").alias("all"), F.count(F.lit(1)).alias("kinds")).where("all > 1")
    status = saved(runs.join(shared, "g").select("g", "r", (F.col("c") > 1).alias("whole"), (F.col("kinds") > 1).alias("mixed"), "c"))
    parts = 4 * shuffle_partitions(rows.sparkSession)
    # a sample in proportion to the buckets, runs drawn by how often they occur (the smallest of exponential times at these rates)
    drawn = -F.log((F.xxhash64("g", "r").bitwiseAND(F.lit(2**52 - 1)) + 1) / F.lit(float(2**52))) / F.col("c")
    sample = status.where("mixed").orderBy(drawn, "g", "r").limit(16 * parts).select("g", F.pmod(F.xxhash64("r"), F.lit(width - core + 1)).alias("off")).toArrow()
    leads = np.sort((sample.column("g").to_numpy().view(np.uint64) & ~_LOW) | sample.column("off").to_numpy().astype(np.uint64))
    splitters = np.unique(leads[np.linspace(0, len(leads) - 1, min(len(leads), 4 * parts)).astype(int)]) if len(leads) else leads
    marks = saved(anchors.join(status, ["g", "r"]).select("k1", "k2", "g", "pos", "whole", "mixed"))
    mixed = marks.where("mixed").groupBy("k1", "k2").agg(F.collect_set(F.struct("g", "pos")).alias("runs"))
    pieces = (rows.join(mixed.hint("shuffle_hash"), ["k1", "k2"]).select("k1", "k2", "id", "text", "runs")
              .mapInArrow(_suffixes(width, splitters), _PIECE))
    sorted_spans = pieces.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_sort_bucket(width), "k1 bigint, k2 int, s int, e int")
    lo = F.shiftright("pos", 32)
    last = lo + F.shiftright("pos", 16).bitwiseAND(F.lit(0xFFFF))
    whole = marks.where("whole").select("k1", "k2", lo.cast("int").alias("s"), (last + width).cast("int").alias("e"))
    return whole.union(sorted_spans).groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 400, core: int | None = None) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs``."""
    if not 0 < width <= int(_LOW):
        raise ValueError(f"width {width} is not within 1 to {int(_LOW)}")
    ship_package(docs.sparkSession)
    core = core or max(1, width // 2)
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("~"))
    rows = docs.select(F.xxhash64(name, text, F.col(text_col).isNull()).alias("k1"), F.hash(text, name).alias("k2"), F.col(id_col).alias("id"), text.alias("text"))
    spans = repeated_spans(rows, width, core)
    id_type = rows.schema["id"].dataType.simpleString()
    return (rows.join(spans.hint("shuffle_hash"), ["k1", "k2"], "left").select("k1", "k2", "id", "text", "spans")
            .select("id", "text", "spans")
            .mapInArrow(_cut, f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
