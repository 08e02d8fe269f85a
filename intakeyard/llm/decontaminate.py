"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items become word sequences (A-Z lower-cased, words are runs of ASCII
letters, digits and all non-ASCII characters) joined by single spaces; every window of
``window`` consecutive item words (the whole item if it is shorter) is a pattern with a space
at both ends, so a byte occurrence is a word occurrence. The machine is built once per
worker from the benchmark windows, sent to the tasks only after their size has been counted; documents are
scanned where they are read, without a shuffle. Windows of more than ``limit`` bytes are dealt into shards of about that size, with a
machine each; the documents are scanned once a shard, one shard being sent at a time, and what the shards found is put together.

Defined results: null or wordless texts have no words, no hits and are not contaminated;
null or wordless items have no window; a null item id is written as an empty string; items with the same
id count once; repeated documents are judged row by row; an empty benchmark hits nothing and an
empty table gives an empty result. Only the named columns are read unless ``carry`` names more.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm.common import BROADCAST_LIMIT, documents, saved
from intakeyard.llm.textbytes import blocks_of, text_views
from intakeyard.llm.wu_manber import WuManber
from intakeyard.session import ship_package
from intakeyard.sources.tables import load

#: A-Z to a-z; digits, a-z and every byte of a non-ASCII character stay; all else is a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
#: The same in the JVM, for windows in shards; a shard holds so many bytes at least.
MIN_SHARD = 1 << 10
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text) -> list[bytes]:
    return bytes(text).translate(WORD_BYTES).split(b" ")


def windows_of(text: bytes, window: int) -> list[bytes]:
    w = [x for x in _words(text) if x]
    return [b" " + b" ".join(w[i:i + window]) + b" " for i in range(max(1, len(w) - window + 1))] if w else []


ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())])

_MACHINES: dict[str, WuManber] = {}


def _machine(tag: str, patterns: list[bytes]) -> WuManber:
    """The machine of the benchmark at hand, built once per worker."""
    if tag not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[tag] = WuManber(patterns)
    return _MACHINES[tag]


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", carry: list[str] | None = None,
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 13, share: float = 0.05,
                  limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The ``carry`` columns with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``
    (hit words, at least ``share`` of all words). Added names win over carried ones."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).where("length(text) > 0")
    names = {f.name.lower() for f in ADDED}
    carried = [c for c in carry or [] if c.lower() not in names]
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    if size * window > limit:
        return _by_shards(docs, items, text_col, carried, window, share, limit)
    owners: dict[bytes, set[str]] = {}
    for row in items.collect():  # bounded by the size just counted
        for p in windows_of(row.text.encode(), window):
            owners.setdefault(p, set()).add(row.item)
    patterns, tag = sorted(owners), uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(
        (patterns, [p.count(b" ") - 1 for p in patterns], [sorted(owners[p]) for p in patterns]))
    ship_package(docs.sparkSession)
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"))
    schema = T.StructType([source.schema[c] for c in carried] + list(ADDED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lengths, owner = sent.value
        machine = _machine(tag, found)
        for batch in batches:
            views = list(text_views(batch.column(batch.num_columns - 1)))
            for a, b in blocks_of([len(v) for v in views], 8 << 20):
                cols = [batch.column(i).slice(a, b - a) for i in range(len(carried))]
                yield pa.RecordBatch.from_arrays(cols + _scan(views[a:b], machine, np.array(lengths, np.int64), owner, share),
                                                 names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def _scan(views: list[np.ndarray], machine: WuManber, lengths: np.ndarray, owner: list[list[str]], share: float) -> list[pa.Array]:
    texts, n_words = [], []
    for v in views:
        words = v.tobytes().translate(WORD_BYTES).split()
        n_words.append(len(words))
        texts.append(b" " + b" ".join(words) + b" ")
    raw = b"".join(texts)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = machine.search(raw)
    n_hit, items = np.zeros(len(views), np.int64), [set() for _ in views]
    if found:
        spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
        at, pat = np.array(found, np.int64).T
        slot = np.searchsorted(spaces, at)
        marks = np.zeros(len(spaces) + 1, np.int64)
        np.add.at(marks, slot, 1)
        np.add.at(marks, slot + lengths[pat], -1)
        total = np.concatenate([[0], np.cumsum(np.cumsum(marks)[:-1] > 0)])
        edge = np.searchsorted(spaces, starts)
        n_hit = total[edge[1:]] - total[edge[:-1]]
        for d, p in set(zip((np.searchsorted(starts, at, "right") - 1).tolist(), pat.tolist(), strict=True)):
            items[d].update(owner[p])
    n = np.array(n_words, np.int64)
    return [pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
            pa.array((n_hit > 0) & (n_hit >= share * n - 1e-9), pa.bool_())]


def _shard_hits(sent, tag: str):
    """``(row, words, items)`` of the texts in which a shard's windows occur: positions of hit words, items of the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, lengths, owner = sent.value
        machine = _machine(tag, found)
        for batch in batches:
            out = []
            for row, view in zip(batch.column(0).to_pylist(), text_views(batch.column(1)), strict=True):
                raw = b" " + b" ".join(view.tobytes().translate(WORD_BYTES).split()) + b" "
                hits = machine.search(raw)
                if hits:
                    spaces = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
                    words = np.unique(np.concatenate([np.arange(lengths[p]) + np.searchsorted(spaces, at) for at, p in hits]))
                    out.append((row, words.tolist(), sorted({i for _, p in hits for i in owner[p]})))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in out], pa.int64()), pa.array([w for _, w, _ in out], pa.list_(pa.int32())),
                                              pa.array([i for _, _, i in out], pa.list_(pa.string()))], names=["row", "words", "items"])

    return run


def _by_shards(docs: DataFrame, items: DataFrame, text_col: str, carried: list[str], window: int, share: float, limit: int) -> DataFrame:
    """The same result with the windows in shards of about ``limit`` bytes (at least ``MIN_SHARD``)."""
    spark = docs.sparkSession
    ship_package(spark)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(F.regexp_replace(lower, NOT_WORD, " "), " "), "")
    size = F.least(F.size("words"), F.lit(window))
    cut = items.select("item", words.alias("words")).where("size(words) > 0").select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("words") - size), lambda i: F.concat_ws(" ", F.slice("words", i + 1, size)))).alias("win"))
    windows = saved(cut.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items")))
    total = windows.agg(F.coalesce(F.sum(F.octet_length("win")), F.lit(0))).first()[0]
    shards = max(1, -(-total // max(limit, MIN_SHARD)))
    rows = saved(docs.select(*[F.col(f"`{c}`") for c in carried], F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))
    texts = rows.select("row", "doc.text")
    hits = None
    for k in range(shards):
        part = windows.where(F.pmod(F.xxhash64("win"), F.lit(shards)) == k).collect()  # about ``limit`` bytes
        found = [b" " + r.win.encode() + b" " for r in part]
        sent = spark.sparkContext.broadcast((found, [p.count(b" ") - 1 for p in found], [r["items"] for r in part]))
        now = saved(texts.mapInArrow(_shard_hits(sent, uuid.uuid4().hex), "row bigint, words array<int>, items array<string>"))
        sent.destroy()
        hits = now if hits is None else hits.unionByName(now)
    n_hit = hits.select("row", F.explode("words").alias("word")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    held = hits.groupBy("row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))  # one list a shard
    base = rows.select("row", *[F.col(f"doc.`{c}`") for c in carried], "doc.text").withColumn("n_words", F.size(words).cast("long")).drop("text")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    of = F.coalesce("items", F.array().cast("array<string>"))
    return (base.join(n_hit, "row", "left").join(held, "row", "left")
            .select(*[F.col(f"`{c}`") for c in carried], "n_words", n.alias("n_hit"), F.size(of).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", of), 256).alias("items_sha256"), ((n > 0) & (n >= share * F.col("n_words") - 1e-9)).alias("contaminated")))


def op7_decontaminate(spark, sf_dir):
    return decontaminate(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"), carry=["doc_id"])
