"""MinHash near-dedup with sequential Bayesian verification of banded candidates.

1. Documents with the same word sequence form a class (128-bit cryptographic digest); from here on a class
   is one row, so any number of exact copies costs nothing more.
2. A class has a MinHash signature over its 5-word shingles, cut in bands; classes
   that share a band bucket are candidates. Buckets with the same members are compared once,
   and a large bucket is cut into blocks that are compared two by two in tasks of their own.
3. Inside a task, pairs of a bucket are compared batch by batch of the signature. With ``m`` agreements in
   ``n`` places and a flat prior, the similarity is Beta(m + 1, n - m + 1); a pair is
   pruned once its chance to reach the threshold is below ``miss``. Survivors are
   verified exactly on their full shingle sets, unless they are already linked through verified links,
   so a task returns stars: fewer links than rows, with the same components.
4. Components come from the verified links by star contraction.

With 24 bands of 5 places a pair at similarity 0.85 misses every band with probability
7e-7 (0.80: 7e-5). Pair order inside a bucket only decides which links of a component are
reported, never which documents are connected.

Defined results: null, empty and all-white texts have an empty set, no links, and stand for themselves; a
text of fewer than five words is one shingle; null ids form no smallest id unless a whole component
has none; repeated rows are linked (same set); an empty table gives an empty result. Only the
id and the text are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intakeyard.llm.common import documents, keyed, saved
from intakeyard.llm.components import components
from intakeyard.llm.shingles import digest, shingle_hashes, words_of
from intakeyard.llm.textbytes import blocks_of, text_views
from intakeyard.session import ship_package

BANDS, ROWS, BATCH, WORDS = 24, 5, 24, 5
PLACES = BANDS * ROWS
_RNG = np.random.Generator(np.random.PCG64(97))
_TURN = _RNG.integers(0, 2**63, PLACES, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of the fixed-size filter that keeps texts no task asks for from travelling, and hashes per key.
FILTER_BITS, FILTER_HASHES = 1 << 23, 3
#: A block holds at most so many classes and so many shingles.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 2_000_000


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """``(n, m)``: after ``n`` places, pairs with fewer than ``m`` agreements are pruned."""
    out = []
    for n in range(BATCH, PLACES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:  # P(similarity >= threshold | m of n) = P(Binomial(n + 1, threshold) <= m)
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, id, cls, n, sig)`` for batches of ``(key, id, text)``."""
    for batch in batches:
        views = [v.tobytes() for v in text_views(batch.column(2))]
        for a, b in blocks_of([len(v) for v in views], 4 << 20):
            words = [words_of(v) for v in views[a:b]]
            x, count = shingle_hashes(words, WORDS)
            start = np.concatenate([[0], np.cumsum(count)])
            n = [len(np.unique(x[s:e])) for s, e in zip(start[:-1], start[1:], strict=True)]
            filled = np.flatnonzero(count)
            sig = np.zeros((b - a, PLACES), np.uint32)
            if len(filled):
                for j in range(PLACES):
                    sig[filled, j] = np.minimum.reduceat((x ^ _TURN[j]) * _TIMES[j], start[filled]) >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                 pa.array([digest(w) for w in words], pa.binary()), pa.array(n, pa.int64()),
                 pa.array([r.tobytes() for r in sig], pa.binary())], names=["key", "id", "cls", "n", "sig"])


class _Sets:
    """Sorted shingle hashes per text of a block, made when first needed."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.made = texts, {}

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.made:
            self.made[i] = np.unique(shingle_hashes([words_of(self.texts[i])], WORDS)[0])
        return self.made[i]


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    both = int(np.count_nonzero(large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pack(wanted: np.ndarray):
    """Texts compressed: a text travels once for each bucket its class is compared in. Texts that the filter ``wanted``
    does not name are in no task and stay behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(2).to_numpy()
            asked = np.flatnonzero(named_bits(h, wanted))
            views = list(text_views(b.column(1)))
            packed = [len(views[i]).to_bytes(8, "little") + pa.compress(views[i].tobytes(), codec="zstd", asbytes=True) for i in asked]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(asked)), pa.array(packed, pa.binary())], names=["key", "packed"])

    return run


def packed_texts(rows: DataFrame, needed: DataFrame, carry: list[str]) -> DataFrame:
    """``(cls, *carry, packed)``: the texts of ``needed`` (``key``, ``cls``, ``carry``), found in ``rows`` (``key``, ``text``)."""
    needed = saved(needed)
    texts = rows.select("key", "text", F.xxhash64("key").alias("h")).mapInArrow(_pack(hash_filter(needed, F.xxhash64("key"))), "key string, packed binary")
    return texts.join(needed.hint("shuffle_hash"), "key").select("cls", *carry, "packed")


def named_bits(h: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which hashes the filter ``wanted`` names."""
    return np.logical_and.reduce([wanted[(h >> (20 * k)) & (FILTER_BITS - 1)] for k in range(FILTER_HASHES)])


def hash_filter(keys: DataFrame, h: Column) -> np.ndarray:
    """A Bloom filter of the hashes ``h``: ``FILTER_BITS`` bits, whatever the number of keys (a full one lets all pass)."""
    at = F.explode(F.array(*[F.shiftright(h, 20 * k).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in range(FILTER_HASHES)]))
    words = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _unpacked(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def stars(names: list[bytes], links: list[tuple[int, int]]) -> pa.Table:
    """``(a, b)``: the components of ``links`` as stars around their smallest names, which contract in few rounds."""
    near: dict[int, list[int]] = {}
    for i, j in links:
        near.setdefault(i, []).append(j)
        near.setdefault(j, []).append(i)
    out, seen = [], set()
    for s in near:
        if s not in seen:
            seen.add(s)
            members = [s]
            for i in members:
                new = [j for j in near[i] if j not in seen]
                seen.update(new)
                members += new
            least = min(names[i] for i in members)
            out += [(least, names[i]) for i in members if names[i] != least]
    return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})


def _verify(percent: int, miss: float):
    steps = least_matches(percent / 100, miss)

    def run(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_pylist()
        distinct = {c: i for i, c in enumerate(cls)}  # repeated rows of a representative fall together here
        rows = sorted(distinct.values())
        sig = np.array([np.frombuffer(table.column("sig")[i].as_py(), np.uint32) for i in rows])
        own = table.column("own").to_numpy()[rows]
        band, bi, bj = (table.column(c)[0].as_py() for c in ("band", "bi", "bj"))
        texts = _Sets([_unpacked(table.column("packed")[i].as_py()) for i in rows])
        left, right = np.flatnonzero(own == bi), np.flatnonzero(own == bj)
        found = []
        for k, i in enumerate(left):
            js, same = (right[k + 1:] if bi == bj else right), 0
            same = np.zeros(len(js), np.int64)
            for n, m in steps:
                same += (sig[js, n - BATCH:n] == sig[i, n - BATCH:n]).sum(1)
                keep = same >= m
                js, same = js[keep], same[keep]
                if len(js) == 0:
                    break
            if len(js):
                shared = (sig[js].reshape(-1, BANDS, ROWS) == sig[i].reshape(BANDS, ROWS)).all(2)
                keep = shared.argmax(1) == band  # a pair belongs to the first band it shares
                found.append(np.stack([np.full(keep.sum(), i), js[keep], same[keep]], 1))
        links = []
        if found:
            pairs = np.concatenate(found)
            root = list(range(len(rows)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, j, _ in pairs[np.argsort(-pairs[:, 2], kind="stable")].tolist():
                a, b = find(i), find(j)
                if a != b and _linked(texts[i], texts[j], percent):
                    root[a] = b
                    links.append((i, j))
        return stars([cls[i] for i in rows], links)

    return run


def candidates(classes: DataFrame) -> DataFrame:
    """Members of the signature's band buckets; the low bits of a bucket hold its band."""
    return members_of(classes.select("cls", F.explode(F.array(*[
        F.xxhash64(F.lit(b), F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS)).bitwiseAND(F.lit(~31)).bitwiseOR(F.lit(b))
        for b in range(BANDS)])).alias("bucket")), classes)


def members_of(named: DataFrame, classes: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """``(bucket, band, blocks, own, n, cls)``: members of the buckets to compare and the block each is in.

    ``named`` has ``(cls, bucket)``. Only the members of shared buckets (all of two members or more, unless given) are looked at
    further, and of buckets with the same members one.
    """
    if shared is None:
        shared = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    members = saved(named.join(shared, "bucket").join(classes.select("cls", "n"), "cls"))
    buckets = (members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
        .groupBy("c", "total", "x", "y").agg(F.min(F.struct((F.col("bucket").bitwiseAND(F.lit(31))).alias("band"), "bucket")).alias("first"))
        .select(F.col("first.bucket").alias("bucket"), F.col("first.band").cast("int").alias("band"), _blocks("c", "total").alias("blocks")))
    return members.join(buckets, "bucket").select("bucket", "band", "blocks", _block("blocks").alias("own"), "n", "cls")


def _blocks(count: str, total: str) -> Column:
    return F.greatest(F.ceil(F.col(count) / BLOCK_ROWS), F.ceil(F.col(total) / BLOCK_SHINGLES)).cast("int")


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("cls", F.lit(2)), F.col(blocks)).cast("int")


def within_blocks(members: DataFrame) -> DataFrame:
    """Tasks that compare each block with itself. A hub, one member of the bucket, joins every block of its bucket,
    so a group of near copies that fills many blocks is mostly linked through it by work in proportion to its size."""
    hubs = (members.where("blocks > 1").groupBy("bucket", "band", "blocks").agg(F.min(F.struct("cls", "own")).alias("hub"))
            .select("bucket", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"), "hub").where("at <> hub.own"))
    own = members.select("bucket", "band", F.col("own").alias("bi"), F.col("own").alias("bj"), "own", "cls")
    return own.union(hubs.select("bucket", "band", F.col("at").alias("bi"), F.col("at").alias("bj"), F.col("at").alias("own"), "hub.cls"))


def across_blocks(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Tasks for what is left of the buckets of several blocks, given the components found so far.

    Members of a bucket's largest component need no comparison with each other; all others meet every block.
    A bucket that has become one component asks for nothing."""
    large = members.where("blocks > 1").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    groups = large.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("total"))
    per = (groups.groupBy("bucket").agg(F.max(F.struct("c", "total", "root")).alias("top"), F.sum("c").alias("c"), F.sum("total").alias("total"))
           .where("c > top.c").select("bucket", F.col("top.root").alias("top"), (F.col("c") - F.col("top.c")).alias("c"),
                                      (F.col("total") - F.col("top.total")).alias("total"))
           .select("bucket", "top", _blocks("c", "total").alias("odd")))
    left = large.join(per, "bucket")
    odd = left.where("root <> top").withColumn("own", _block("odd")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("odd") + F.col("blocks") - 1)))
    top = left.where("root = top").withColumn("own", F.col("odd") + F.col("own")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("odd") - 1)))
    return odd.union(top.select(*odd.columns)).select("bucket", "band", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "cls")


def _sketched(docs: DataFrame, id_col: str, text_col: str, percent: int, miss: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, one row per class, and ``(node, root)`` of the classes that have links."""
    ship_package(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    sketch = saved(rows.select("key", "id", "text").mapInArrow(_sketch, f"key string, id {id_type}, cls binary, n bigint, sig binary"))
    classes = sketch.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.min("key").alias("key"),
                                                       F.max("n").alias("n"), F.max("sig").alias("sig"))
    classes = saved(classes)
    return sketch, classes, linked_classes(rows, classes, saved(candidates(classes)), _verify(percent, miss), ["sig"])


def linked_classes(rows: DataFrame, classes: DataFrame, members: DataFrame, verify, carry: list[str]) -> DataFrame:
    """``(node, root)`` of the classes that have links, by ``verify`` on the texts of each block or pair of blocks.

    ``rows`` has ``(key, text)``, ``classes`` a ``key`` per ``cls`` and the ``carry`` columns that ``verify`` reads."""

    def links(tasks: DataFrame) -> DataFrame:
        needed = classes.join(tasks.select("cls").distinct(), "cls", "left_semi").select("key", "cls", *carry)
        texts = packed_texts(rows, needed, carry)
        return tasks.join(texts, "cls").groupBy("bucket", "band", "bi", "bj").applyInArrow(verify, "a binary, b binary")

    roots = components(links(within_blocks(members)))
    if not members.where("blocks > 1").isEmpty():
        rest = saved(across_blocks(members, roots))
        if not rest.isEmpty():
            roots = components(links(rest).union(roots.select("node", "root")))
    return roots


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """``(key, component)``: the group of near copies of every different ``key``, whatever the ids are."""
    sketch, _, roots = _sketched(docs, id_col, text_col, percent, miss)
    return (sketch.select("key", "cls").distinct().join(roots.withColumnRenamed("node", "cls"), "cls", "left")
            .select("key", F.coalesce("root", "cls").alias("component")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """``(key, id, n_shingles, component_id, kept, keep_row)`` for every row of ``docs``.

    Links hold when ``100 * intersection >= percent * union``. ``key`` is ``common.row_key``.
    """
    sketch, classes, roots = _sketched(docs, id_col, text_col, percent, miss)
    linked = (roots.join(classes.select(F.col("cls").alias("node"), "id"), "node"))
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    named = linked.join(smallest, "root").select(F.col("node").alias("cls"), "component_id")
    alone = classes.join(named, "cls", "left_anti").select("cls", F.col("id").alias("component_id"))
    return (sketch.drop("sig").join(named.unionByName(alone), "cls", "left")
            .select("key", "id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def op3_near_dedup(spark, sf_dir):
    return near_dedup(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
