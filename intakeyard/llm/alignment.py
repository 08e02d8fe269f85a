"""Alignment of two tokenizers on the same bytes, with an identity map for the ids that mean the same.

Each text is cut by both tokenizers. Byte offsets where tokens of both end cut it into groups; every overlap of a token of A
with one of B is a link. An id pair is counted once per document that holds it linked.

1. An array gives, for each id of A, the id of B with the same bytes. A link that it names (nearly all groups of one token on
   either side) is counted in a vector of A's length, one vector per task, and never enters a shuffle of pairs.
2. Only the other pairs, distinct within a document, are grouped by pair.
3. A link's own figures need the count of its pair and the highest count of its A id. The vectors (A's length, a proven
   bound) and the pairs that hold at least one in ``HEAVY`` of all pair rows (at most ``HEAVY``, a proven bound) are sent to
   all tasks; only rows of rarer pairs meet their counts by a join, whose keys are thus all small.

Texts are tokenized once; what the second step needs is written to the shared folder, so a lost task reads it again.
Defined results: null and empty texts, and texts whose joined token bytes differ from a space and the text (a text with
U+2581, which B takes for a space), have no tokens: zeros and an empty ``groups``. Repeated rows count as documents of their
own; null ids pass through; very long texts are cut by pieces of A and B that never merge; ties for the highest count all
count; an empty table gives an empty result. Only the id and the text are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intakeyard.llm.byte_bpe import PIECES, byte_characters
from intakeyard.llm.common import documents, saved
from intakeyard.llm.pieces import PieceIds
from intakeyard.llm.textbytes import blocks_of
from intakeyard.session import ship_package

MARK = "▁"
#: Pairs that hold at least one in so many of all pair rows go to all tasks.
HEAVY = 65_536
CACHE = 200_000
#: Characters of text aligned at a time (one text at least).
BLOCK_CHARS = 1 << 20
#: B merges nothing over the start of a run of spaces (checked against its pieces).
RUNS = re.compile(r" +[^ ]*")
_B = np.int64(1 << 32)


class Aligner:
    """Both tokenizers, their token bytes and the identity map; one per Python worker."""

    def __init__(self, a_path: str, b_path: str, cache: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        a.encode_special_tokens = True
        byte_of = {c: i for i, c in enumerate(byte_characters())}
        special = {t.content for t in a.get_added_tokens_decoder().values()}
        a_bytes = [b""] * a.get_vocab_size()
        for token, i in a.get_vocab().items():
            a_bytes[i] = token.encode() if token in special else bytes(byte_of[c] for c in token)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece of B goes on behind the end of a word")
        b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        same = {}
        for i in sorted(range(len(pieces)), key=lambda i: (b.is_byte(i), i)):
            if not (b.is_control(i) or b.is_unknown(i)):
                same.setdefault(b_bytes[i], i)
        self.same = np.array([same.get(x, -1) for x in a_bytes], np.int64)
        self.a = PieceIds(lambda p: [e.ids for e in a.encode_batch_fast(p, add_special_tokens=False)], cache)
        space = [b.piece_to_id(MARK)]  # B puts the first space itself, but not before an empty text
        self.b = PieceIds(lambda p: [ids or space for ids in b.encode([x[1:] for x in p], num_threads=1)], cache)
        self.a_bytes, self.b_bytes = pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary())
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (a_bytes, b_bytes))
        n, m = len(a_bytes), len(b_bytes)
        self.shown = pa.array([f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)]
                              + [f"{i};" for i in range(m)], pa.large_string())

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B per text, both empty where the joined bytes differ from the space and the text."""
        full = [" " + t for t in texts]
        out = []
        for find, ids, table, size in ((PIECES.findall, self.a, self.a_bytes, self.a_size), (RUNS.findall, self.b, self.b_bytes, self.b_size)):
            pieces = [find(t) for t in full]
            flat, per_piece = ids.of([p for row in pieces for p in row])
            ends = np.concatenate([[0], np.cumsum(per_piece)])[np.cumsum([0] + [len(row) for row in pieces])]
            at = np.concatenate([[0], np.cumsum(size[flat])])[ends]
            out.append((flat, ends, memoryview(_joined(table.take(pa.array(flat)))), at))
        rows = ([], [])
        for i, text in enumerate(full):
            raw = text.encode()
            fits = len(raw) > 1 and all(data[at[i]:at[i + 1]] == raw for _, _, data, at in out)
            for side, (flat, ends, _, _) in zip(rows, out, strict=True):
                side.append(flat[ends[i]:ends[i + 1]] if fits else flat[:0])
        return rows


def _joined(a: pa.Array) -> bytes:
    if len(a) == 0:
        return b""
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    return a.buffers()[2].slice(int(off[0]), int(off[-1] - off[0])).to_pybytes()


class Links:
    """Groups and links of a run of texts: cuts of both tokenizers merged, one link per piece between neighbouring cuts."""

    def __init__(self, tool: Aligner, a_rows: list[np.ndarray], b_rows: list[np.ndarray]):
        self.n_a, self.n_b = (np.array([len(r) for r in rows], np.int64) for rows in (a_rows, b_rows))
        a, b = (np.concatenate([*rows, np.empty(0, np.int32)]).astype(np.int64) for rows in (a_rows, b_rows))
        a_end, b_end = np.cumsum(tool.a_size[a]), np.cumsum(tool.b_size[b])
        mark = np.zeros((a_end[-1] if len(a_end) else 0) + 1, np.uint8)  # one per byte of the texts at hand
        mark[a_end] |= 1
        mark[b_end] |= 2
        ends = mark[np.flatnonzero(mark)]
        at_a, at_b, common = np.flatnonzero(ends & 1), np.flatnonzero(ends & 2), ends == 3
        a_of, b_of = np.cumsum(ends & 1) - (ends & 1), np.cumsum(ends >> 1) - (ends >> 1)  # the tokens between a cut and the one before
        self.a, self.b = a[a_of], b[b_of]
        self.doc = np.repeat(np.arange(len(a_rows)), self.n_a)[a_of]
        # a group ends with each common cut; a text ends with one
        self.groups = np.bincount(self.doc[common], minlength=len(a_rows))
        before = np.cumsum(common) - common
        a_group, b_group = before[at_a], before[at_b]
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        order = np.lexsort((np.arange(len(side)), side, np.concatenate([a_group, b_group])))
        n, m = len(tool.a_size), len(tool.b_size)
        shown = np.concatenate([a + n * _last(a_group), 2 * n + b + m * _last(b_group)])[order]
        self.shown = tool.shown.take(pa.array(shown))
        self.shown_ends = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])

    def text(self, i: int) -> bytes:
        """The groups of one text as ``a1,a2|b1;a3|b2,b3``."""
        return _joined(self.shown.slice(self.shown_ends[i], self.shown_ends[i + 1] - self.shown_ends[i]))[:-1]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, a, b, links)``: each pair once per text, in order of text."""
        key = np.sort((self.doc << 48) | (self.a << 24) | self.b)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        n, key = np.diff(np.append(first, len(key))), key[first]
        return key >> 48, (key >> 24) & 0xFFFFFF, key & 0xFFFFFF, n


def _last(group: np.ndarray) -> np.ndarray:
    """1 for the last of each run of equal values."""
    return np.concatenate([group[1:] != group[:-1], [True]]).astype(np.int64)[:len(group)]


def _lists(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


_TOOLS: dict[tuple, Aligner] = {}


def _tool(key: tuple) -> Aligner:
    if key not in _TOOLS:
        _TOOLS[key] = Aligner(*key)
    return _TOOLS[key]


_KINDS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(),
          "same": pa.list_(pa.int32()), "same_n": pa.list_(pa.int32()), "pair": pa.list_(pa.int64()), "pair_n": pa.list_(pa.int32())}


def _align(key: tuple, with_groups: bool):
    """``(row, id, n_a, n_b, n_groups, n_links, groups_sha256, same, same_n, pair, pair_n[, groups])`` per text: distinct A ids
    linked with their identity and the number of such links, then the other pairs (``a * 2**32 + b``) and theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _tool(key)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for s, e in blocks_of([len(t) for t in texts], BLOCK_CHARS):
                for s in range(s, e, 4096):  # the text's number has 15 bits in a pair's key
                    yield block(tool, batch.slice(s, min(e, s + 4096) - s), texts[s:min(e, s + 4096)])

    def block(tool: Aligner, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        n = len(texts)
        links = Links(tool, *tool.tokens(texts))
        doc, a, b, count = links.distinct()
        plain = tool.same[a] == b
        told = [links.text(i) for i in range(n)]
        values = [links.n_a, links.n_b, links.groups, np.bincount(links.doc, minlength=n),
                  [hashlib.sha256(t).hexdigest() if t else "" for t in told]]
        cols = [pa.array(v, k) for v, k in zip(values, _KINDS.values(), strict=False)]
        cols += [_lists(a[plain], doc[plain], n, pa.int32()), _lists(count[plain], doc[plain], n, pa.int32()),
                 _lists((a * _B + b)[~plain], doc[~plain], n, pa.int64()), _lists(count[~plain], doc[~plain], n, pa.int32())]
        names = ["row", "id", *_KINDS]
        if with_groups:
            cols, names = [*cols, pa.array([t.decode() for t in told], pa.string())], [*names, "groups"]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=names)

    return run


def _vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector per task: in how many texts each A id is linked with its identity."""
    count = np.zeros(0, np.int64)
    for batch in batches:
        ids = batch.column(0).flatten().to_numpy()
        found = np.bincount(ids, minlength=len(count))
        found[:len(count)] += count
        count = found
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at], pa.int64())], names=["a", "c"])


def _scored(same_count: np.ndarray, best: np.ndarray, heavy: np.ndarray, heavy_count: np.ndarray):
    """Per row the links of identities and heavy pairs summed up; the rarer pairs go on by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            same, same_n, pair, pair_n = (b.column(i) for i in range(7, 11))
            n = b.num_rows
            n_best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)

            def add(row: np.ndarray, a: np.ndarray, links: np.ndarray, count: np.ndarray) -> None:
                np.add.at(n_best, row, links * (count == best[a]))
                np.add.at(total, row, links * count)

            at = same.flatten().to_numpy()
            add(np.repeat(np.arange(n), np.diff(np.asarray(same.offsets))), at, same_n.flatten().to_numpy().astype(np.int64), same_count[at])
            flat, links = pair.flatten().to_numpy(), pair_n.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(n), np.diff(np.asarray(pair.offsets)))
            where = np.minimum(np.searchsorted(heavy, flat), max(0, len(heavy) - 1))
            known = heavy[where] == flat if len(heavy) else np.zeros(len(flat), bool)
            add(row[known], flat[known] >> 32, links[known], heavy_count[where[known]])
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(7)] + [pa.array(n_best), pa.array(total), _lists(flat[~known], row[~known], n, pa.int64()),
                                                   _lists(links[~known], row[~known], n, pa.int32())],
                names=[*b.schema.names[:7], "n_best", "count_sum", "pair", "pair_n"])

    return run


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", *, with_groups: bool = False,
            cache: int = CACHE) -> DataFrame:
    """Both tokenizations of every text with their groups and distinct links (columns as in ``_align``); not yet written."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"row bigint, id {rows.schema['id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, same array<int>, same_n array<int>, pair array<bigint>, pair_n array<int>")
    return rows.mapInArrow(_align((a_path, b_path, cache), with_groups), schema + (", groups string" if with_groups else ""))


def same_counts(table: DataFrame) -> DataFrame:
    """``(a, c)``: in how many texts each id of A is linked with its identity; ``table`` is a written result of ``aligned``."""
    return table.select("same").mapInArrow(_vector, "a int, c bigint").groupBy("a").agg(F.sum("c").alias("c"))


def other_counts(table: DataFrame) -> DataFrame:
    """``(pair, c)``: in how many texts every other pair is linked."""
    return table.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("c"))


def pair_counts(table: DataFrame, a_path: str, b_path: str, cache: int = CACHE) -> DataFrame:
    """``(a_id, b_id, documents)`` of every linked pair."""
    same = [(i, b) for i, b in enumerate(_tool((a_path, b_path, cache)).same.tolist()) if b >= 0]
    named = table.sparkSession.createDataFrame(same, "a int, b int")  # A's length at most
    other = other_counts(table).select(F.shiftright("pair", 32).cast("int"), F.col("pair").bitwiseAND(F.lit(2**32 - 1)).cast("int"), "c")
    return same_counts(table).join(F.broadcast(named), "a").select(F.col("a").alias("a_id"), F.col("b").alias("b_id"), F.col("c").alias("documents")).union(other)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", *, heavy: int = HEAVY,
          cache: int = CACHE) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs``."""
    spark = docs.sparkSession
    table = saved(aligned(docs, a_path, b_path, id_col, text_col, cache=cache))
    size = len(_tool((a_path, b_path, cache)).same)
    plain, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    found = same_counts(table).toArrow()  # A's length at most, as the next
    plain[found["a"].to_numpy()] = found["c"].to_numpy()
    other = saved(other_counts(table))
    found = other.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("c").alias("c")).toArrow()
    best[found["a"].to_numpy()] = found["c"].to_numpy()
    best = np.maximum(best, plain)
    total = other.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    top = other.where(F.col("c") * F.lit(heavy) >= F.lit(total)).toArrow().sort_by("pair")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields[:7])
    scored = saved(table.mapInArrow(_scored(plain, best, top["pair"].to_numpy(), top["c"].to_numpy()),
                                    schema + ", n_best bigint, count_sum bigint, pair array<bigint>, pair_n array<int>"))
    rare = scored.select("row", F.explode(F.arrays_zip("pair", "pair_n")).alias("p")).select("row", "p.pair", F.col("p.pair_n").alias("n"))
    highest = spark.createDataFrame([(i, b) for i, b in enumerate(best.tolist()) if b], "a int, best bigint")
    light = other.where(F.col("c") * F.lit(heavy) < F.lit(total))
    known = (light.withColumn("a", F.shiftright("pair", 32).cast("int")).join(F.broadcast(highest), "a")
             .select("pair", "c", (F.col("c") == F.col("best")).cast("bigint").alias("top")))
    more = rare.join(known, "pair").groupBy("row").agg(F.sum(F.col("n") * F.col("top")).alias("more_best"), F.sum(F.col("n") * F.col("c")).alias("more_sum"))
    return (scored.join(more, "row", "left")
            .select("id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256"))


def op13_alignment(spark, sf_dir):
    import public_tokenizers as P

    return align(documents(spark, sf_dir), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")
