"""N-gram Jaccard join by a blocked sparse matrix product of the document by n-gram incidence.

1. Documents with the same word sequence form a class (cryptographic digest) and are one row from then on.
2. All n-grams are put in one order, rare ones first as a fixed-size table of counts over all documents tells, then by hash.
   Two sets that link share one of the first ``n - ceil(t * n) + 1`` n-grams of each (``n`` its size, ``t`` the threshold), so
   only these columns of the incidence matrix name the blocks to multiply. The order decides how large blocks get, never
   what is found, so errors of the table cost nothing but time. Where the first n-gram that two sets share stands ``i``-th in the
   order of one, they share at most ``n - i + 1``: a column of two documents whose sizes and places rule a link out is dropped,
   as is one that holds no document early enough to be the smaller of a pair. A column of very many is cut into blocks.
3. Blocks are multiplied in condensed form first: a document's n-grams counted in ``PROFILE`` column groups. What two documents
   share is at most the sum of the lesser counts, and a pair whose sum is below the least overlap that the two sizes ask for
   is discarded without a text being moved. What is left of a block falls into sets of documents; equal sets are one.
4. A task multiplies the incidence matrix of such a set, all n-grams of its documents, with its transpose: columns with the
   same documents are one weighted column, and column block by column block overlaps add up. A pair leaves as soon as its
   overlap so far and what both sides still have cannot reach the least overlap; rows without pairs leave the product. Full
   overlaps that reach it are links, and a task returns their components as stars.
5. This is done twice: for the first ``LEADS`` columns of each document only, which joins most of each group of near copies, then
   for all columns that still hold documents of different components, pairs of one component left out. Components come
   from the links by star contraction.

Defined results: null, empty and all-white texts have an empty set and link with nothing; a text of fewer words than
``width`` is one n-gram; repeated rows link (same set); null ids form no smallest id unless a whole component has none; an
empty table gives an empty result. Only the id and the text are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import documents, keyed, saved
from intakeyard.llm.components import components
from intakeyard.llm.near_dedup import _unpacked, across_blocks, hash_filter, members_of, named_bits, packed_texts, stars, within_blocks
from intakeyard.llm.shingles import digest, shingle_hashes, words_of
from intakeyard.llm.textbytes import blocks_of, text_views
from intakeyard.session import ship_package

#: Cells of the table of counts (its size whatever the number of n-grams), and columns multiplied at a time.
CELLS, COLUMNS = 1 << 18, 4096
#: Column groups of the condensed product, and columns of a document in the first round.
PROFILE, LEADS = 128, 2
WIDTH = 3


def _sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, n-gram)`` without repetition, in order of text and n-gram."""
    x, count = shingle_hashes([words_of(t) for t in texts], width)
    doc = np.repeat(np.arange(len(texts)), count)
    order = np.lexsort((x, doc))
    doc, x = doc[order], x[order]
    new = np.ones(len(x), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (x[1:] != x[:-1])
    return doc[new], x[new]


def _counts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            views = [v.tobytes() for v in text_views(batch.column(0))]
            for a, b in blocks_of([len(v) for v in views], 4 << 20):
                x, _ = shingle_hashes([words_of(v) for v in views[a:b]], width)
                total += np.bincount((x & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["cell", "c"])

    return run


def levels_of(rows: DataFrame, width: int) -> np.ndarray:
    """How common the n-grams of each cell are, in doublings, over all texts: ``CELLS`` bytes."""
    found = rows.select("text").mapInArrow(_counts(width), "cell int, c bigint").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(CELLS, np.uint8)
    out[found["cell"].to_numpy()] = np.log2(found["c"].to_numpy()).astype(np.uint8) + 1
    return out


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _sketch(width: int, percent: int, levels: np.ndarray):
    """``(key, id, cls, n, prefix, profile)`` for batches of ``(key, id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [v.tobytes() for v in text_views(batch.column(2))]
            for a, b in blocks_of([len(v) for v in views], 4 << 20):
                doc, x = _sets(views[a:b], width)
                n = np.bincount(doc, minlength=b - a)
                order = np.lexsort((x, levels[(x & np.uint64(CELLS - 1)).astype(np.int64)], doc))
                rank = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                most = prefix_length(n, percent) * (n > 0)
                first = x[order][rank < most[doc]]
                ends = np.concatenate([[0], np.cumsum(most)]).astype(np.int32)
                cell = (x >> np.uint64(40)).astype(np.int64) & (PROFILE - 1)
                profile = np.minimum(np.bincount(doc * PROFILE + cell, minlength=(b - a) * PROFILE), 255).astype(np.uint8).reshape(b - a, PROFILE)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([digest(words_of(v)) for v in views[a:b]], pa.binary()),
                     pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(first.view(np.int64))),
                     pa.array([r.tobytes() for r in profile], pa.binary())], names=["key", "id", "cls", "n", "prefix", "profile"])

    return run


def least_overlap(size: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a link, for each two rows."""
    return -(-percent * (size[:, None] + size[None, :]) // (100 + percent))


def possible_links(profile: np.ndarray, size: np.ndarray, root: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different roots whose condensed product reaches the least overlap, as a boolean matrix.

    A count of 255 stands for any larger one; a pair that has it on both sides is never discarded by it."""
    out = (np.minimum(size[:, None], size[None, :]) >= least_overlap(size, percent)) & (root[:, None] != root[None, :])
    full = profile == 255
    for i in np.flatnonzero(out.any(1)):
        js = np.flatnonzero(out[i, i + 1:]) + i + 1
        most = np.minimum(profile[i], profile[js]).sum(1, dtype=np.int64)
        unknown = (full[i] & full[js]).any(1)
        keep = unknown | ((100 + percent) * most >= percent * (size[i] + size[js]))
        out[i, i + 1:] = False
        out[i, js[keep]] = True
    upper = np.triu(out, 1)
    return upper | upper.T


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """The bytes of a column whose values all have ``width`` of them, a row each."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]].reshape(-1, width)


def _condensed(percent: int):
    """``(group, cls)``: the sets of a block's documents that its condensed product leaves connected.

    Rows ``(bucket, band, bi, bj, cls, n, profile, root)`` come in order of their blocks. Blocks of two documents, by far the
    most, are multiplied all at once, others one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            starts = bounds(table)
            last = int(starts[-1]) if len(starts) else 0  # the last block may go on in the next batch
            held = table.slice(last)
            yield from blocks(table.slice(0, last), starts[:-1])
        if held is not None and len(held):
            yield from blocks(held, np.array([0]))

    def bounds(table: pa.Table) -> np.ndarray:
        if len(table) == 0:
            return np.empty(0, np.int64)
        keys = [table.column(c).to_numpy() for c in ("bucket", "band", "bi", "bj")]
        return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]))

    def blocks(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(starts) == 0:
            return
        cls, size = table.column("cls").combine_chunks(), table.column("n").to_numpy()
        profile = _fixed(table.column("profile").combine_chunks(), PROFILE)
        root = np.ascontiguousarray(_fixed(table.column("root").combine_chunks(), 16)).view("<u8")
        count = np.diff(np.append(starts, len(table)))
        left = starts[count == 2]
        right = left + 1
        most = np.minimum(profile[left], profile[right]).sum(1, dtype=np.int64)
        unknown = ((profile[left] == 255) & (profile[right] == 255)).any(1)
        total = size[left] + size[right]
        need = -(-percent * total // (100 + percent))
        keep = (root[left] != root[right]).any(1) & (np.minimum(size[left], size[right]) >= need) & (unknown | (most >= need))
        found = [[i, i + 1] for i in left[keep].tolist()]
        for s, n in zip(starts[count > 2].tolist(), count[count > 2].tolist(), strict=True):
            own = root[s:s + n]
            same = np.unique(own, axis=0, return_inverse=True)[1].ravel()
            of = np.arange(n)
            pairs = forest(possible_links(profile[s:s + n], size[s:s + n], same, percent))
            for i, j in pairs:  # a tree's edges come from its first row on
                of[j] = of[i]
            for k in (np.unique(of[[i for i, _ in pairs]]) if pairs else []):
                found.append((s + np.flatnonzero(of == k)).tolist())
        out = []
        for rows in found:
            members = sorted({cls[i].as_py() for i in rows})
            name = hashlib.blake2b(b"".join(members), digest_size=16).digest()
            out += [(name, c) for c in members]
        yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.binary()), pa.array([c for _, c in out], pa.binary())], names=["group", "cls"])

    return run


def overlap_links(doc: np.ndarray, gram: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Linked pairs of the rows of an incidence matrix, given as ``(doc, gram)`` entries, as a boolean matrix.

    ``size`` is the number of entries of each row."""
    c = len(size)
    need = least_overlap(size, percent)
    open_ = np.minimum(size[:, None], size[None, :]) >= need
    np.fill_diagonal(open_, False)
    open_ &= size[:, None] > 0
    linked = np.zeros((c, c), bool)
    doc, col, weight = weighted_columns(doc, gram)
    kinds = len(weight)
    overlap = np.zeros((c, c), np.float64 if size.max(initial=0) >= 1 << 24 else np.float32)
    rest = np.bincount(doc, weights=weight[col], minlength=c)
    live = np.flatnonzero(open_.any(1))
    order = np.argsort(col, kind="stable")
    doc, col = doc[order], col[order]
    edges = np.searchsorted(col, np.arange(0, kinds + COLUMNS, COLUMNS))
    for k, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if len(live) == 0:
            return linked
        place = np.full(c, -1)
        place[live] = np.arange(len(live))
        row, at = place[doc[s:e]], col[s:e] - k * COLUMNS
        rest -= np.bincount(doc[s:e], weights=weight[col[s:e]], minlength=c)
        row, at = row[row >= 0], at[row >= 0]
        block = np.zeros((len(live), min(COLUMNS, kinds - k * COLUMNS)), overlap.dtype)
        block[row, at] = 1
        part = np.ix_(live, live)
        overlap[part] += (block * weight[k * COLUMNS:k * COLUMNS + block.shape[1]].astype(overlap.dtype)) @ block.T
        able = open_[part] & (overlap[part] + np.minimum(rest[live][:, None], rest[live][None, :]) >= need[part])
        open_[part] = able
        live = live[able.any(1)]
    return open_ & (overlap >= need)


def weighted_columns(doc: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ``(doc, col)`` without the columns of one row, columns with the same rows taken as one of their number's weight."""
    _, col, count = np.unique(gram, return_inverse=True, return_counts=True)
    shared = count[col] > 1
    doc, col = doc[shared], col[shared]
    if len(doc) == 0:
        return doc, col, np.zeros(0)
    used, col = np.unique(col, return_inverse=True)
    marks = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, (2, int(doc.max()) + 1), dtype=np.uint64)
    sums = np.zeros((len(used), 2), np.uint64)
    for k in range(2):  # 126 bits tell sets of rows apart
        np.add.at(sums[:, k], col, marks[k][doc])
    order = np.lexsort(sums.T)
    new = np.concatenate([[True], (sums[order[1:]] != sums[order[:-1]]).any(1)])
    kind = np.cumsum(new) - 1
    lead = np.full(len(used), -1)
    lead[order[new]] = kind[new]
    at = lead[col]
    return doc[at >= 0], at[at >= 0], np.bincount(kind).astype(np.float64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs."""
    seen = np.zeros(len(linked), bool)
    out = []
    for s in np.flatnonzero(linked.any(1)):
        if seen[s]:
            continue
        seen[s] = True
        queue = [s]
        while queue:
            i = queue.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            out += [(i, j) for j in new.tolist()]
            queue += new.tolist()
    return out


def _multiply(width: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        cls = table.column("cls").to_pylist()
        rows = sorted({c: i for i, c in enumerate(cls)}.values())  # repeated rows of a representative fall together here
        packed = table.column("packed")
        doc, gram = _sets([_unpacked(packed[i].as_py()) for i in rows], width)
        links = forest(overlap_links(doc, gram, np.bincount(doc, minlength=len(rows)), percent))
        return stars([cls[i] for i in rows], links)

    return run


def shared_columns(classes: DataFrame, percent: int) -> DataFrame:
    """``(bucket)``: columns in which some two classes may have the first n-gram that they share, if sizes and places allow a link."""
    n, pos = F.col("n"), F.col("pos")
    least = lambda total: F.ceil(total * F.lit(percent) / F.lit(100 + percent))
    # columns of one document, nearly all, leave by a plain count; only rows of the others carry their size and place
    many = classes.select(F.explode("prefix").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    at = classes.select("n", "prefix").mapInArrow(_in_columns(hash_filter(many.select("bucket"), F.col("bucket"))), "n bigint, bucket bigint, pos int")
    at = at.select("bucket", (n * F.lit(1 << 31) + pos).alias("at"), (n - pos >= least(2 * n)).alias("early"))
    found = at.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("a"), F.max("at").alias("b"), F.max("early").alias("early"))
    size = lambda c: F.shiftright(c, 31)
    most = lambda c: size(c) - F.col(c).bitwiseAND(F.lit((1 << 31) - 1))  # noqa: E731  overlap at most
    need = least(size("a") + size("b"))
    return found.where("c > 1 AND early").where((F.col("c") > 2) | (F.least(most("a"), most("b")) >= need)).select("bucket")


def _in_columns(wanted: np.ndarray):
    """``(first column, bucket, pos)`` of the columns that the filter names, for rows of a first column and their prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, size = b.column(1).flatten().to_numpy(), np.diff(np.asarray(b.column(1).offsets))
            row = np.repeat(np.arange(b.num_rows), size)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            at = np.flatnonzero(named_bits(flat, wanted))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[at])), pa.array(flat[at]), pa.array(pos[at].astype(np.int32))],
                                             names=[b.schema.names[0], "bucket", "pos"])

    return run


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 90, width: int = WIDTH) -> DataFrame:
    """``(key, id, n_shingles, component_id)`` for every row of ``docs``; ``key`` is ``common.row_key``.

    Links hold when ``100 * intersection >= percent * union``."""
    ship_package(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    sketch = saved(rows.select("key", "id", "text").mapInArrow(_sketch(width, percent, levels_of(rows, width)),
                                                               f"key string, id {id_type}, cls binary, n bigint, prefix array<bigint>, profile binary"))
    classes = saved(sketch.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.min("key").alias("key"), F.max("n").alias("n"),
                                                             F.max("prefix").alias("prefix"), F.max("profile").alias("profile")))
    shared = saved(shared_columns(classes, percent))
    named = classes.select("cls", "prefix").mapInArrow(_in_columns(hash_filter(shared, F.col("bucket"))), "cls binary, bucket bigint, pos int").drop("pos")
    members = saved(members_of(named, classes.select("cls", "n"), shared))

    def links(tasks: DataFrame, roots: DataFrame) -> DataFrame:
        known = classes.select("cls", "n", "profile").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
        condensed = tasks.join(known.select("cls", "n", "profile", F.coalesce("root", "cls").alias("root")), "cls")
        block = ["bucket", "band", "bi", "bj"]
        condensed = condensed.select(*block, "cls", "n", "profile", "root").repartition(*block).sortWithinPartitions(*block)
        groups = saved(condensed.mapInArrow(_condensed(percent), "group binary, cls binary").distinct())
        texts = packed_texts(rows, classes.select("key", "cls").join(groups.select("cls").distinct(), "cls", "left_semi"), [])
        return groups.join(texts, "cls").groupBy("group").applyInArrow(_multiply(width, percent), "a binary, b binary")

    first = Window.partitionBy("cls").orderBy("bucket")
    lead = members.withColumn("k", F.row_number().over(first)).where(F.col("k") <= LEADS).drop("k")
    roots = components(links(within_blocks(lead), docs.sparkSession.createDataFrame([], "node binary, root binary")))
    here = members.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = here.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("bucket")
    left = saved(members.join(mixed, "bucket").select(*members.columns))
    rest = within_blocks(left.where("blocks = 1")).unionByName(across_blocks(left, roots))
    roots = components(links(rest, roots).union(roots.select("node", "root")))
    linked = roots.join(classes.select(F.col("cls").alias("node"), "id"), "node")
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    named = linked.join(smallest, "root").select(F.col("node").alias("cls"), "component_id")
    alone = classes.join(named, "cls", "left_anti").select("cls", F.col("id").alias("component_id"))
    return (sketch.drop("prefix", "profile").join(named.unionByName(alone), "cls", "left")
            .select("key", "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))


def op11_ngram_join(spark, sf_dir):
    return ngram_join(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
