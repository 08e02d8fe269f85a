"""Hard negatives of anchor vectors, with rotated one-bit codes in front of the integer scores.

1. Components become whole numbers (``floor(scale * x)``). Each vector is rotated (random signs and Hadamard transforms, twice)
   and stored with its sign bits ``c``, the part of it along the code (``along``) and the length of the rest (``rest``).
2. Anchors and rows meet in blocks: rows are dealt into slots and anchors into sets of bounded size, and a task takes one slot
   and one set. Nothing is broadcast or collected.
3. In a task an anchor ``y`` is cut in bit planes; popcounts of planes and codes give its product with the code up to a known
   rounding error. As the rest of a row is perpendicular to its code, Cauchy-Schwarz bounds what is missing:
   ``rest * sqrt(|y|^2 - <code, y>^2)``. A row whose interval lies outside what can still be returned is dropped; all other
   rows are scored exactly, so the intervals never decide a result.
4. A slot returns its first rows per anchor (and positive); a grouped rank over the slots gives the result.

Defined results: rows with a null label, a null vector or any null or non-finite component take no part. Every row counts by
itself: a repeated anchor row has its other copies among its positives and gives its results again. Ties go to the smaller id,
null ids last (a null id is never an anchor), then to either row. Vectors of different length have no score; empty vectors
score 0. An anchor without positives, or a positive without fitting rows, gives no rows; an empty table gives an empty
result. Scores and components must fit 64 bits. Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import saved
from intakeyard.session import ship_package
from intakeyard.sources.tables import load

#: Rows of a slot and anchors of a set; bits an anchor's components are cut to.
SLOT_ROWS, SET_ANCHORS, PLANES = 8192, 4096, 6
#: Rows scored first, as the popcounts rank them, to know what a row must reach.
SEEDS = 64
_SEED = 20240719


def rotated(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` padded to a power of two and turned by a fixed orthogonal map."""
    n, d = x.shape
    size = 1 << max(0, (d - 1).bit_length())
    rng = np.random.Generator(np.random.PCG64(_SEED + size))
    out = np.zeros((n, size))
    out[:, :d] = x
    for _ in range(2):
        out *= rng.integers(0, 2, size) * 2.0 - 1.0
        step = 1
        while step < size:
            pair = out.reshape(n, size // (2 * step), 2, step)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, size)
            step *= 2
        out /= np.sqrt(size)
    return out


def codes_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits as words, the part along the code and the length of the rest, of every row."""
    y = rotated(x)
    along = np.abs(y).sum(1) / np.sqrt(max(1, y.shape[1]))
    rest = np.sqrt(np.maximum(0.0, (y * y).sum(1) - along * along))
    return _words(y > 0), along, rest


def _words(bits: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(bits), -(-max(1, bits.shape[1]) // 64) * 64), bool)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column))).astype(np.int64)


def _code(batches):
    """``(row, id, label, dim, vec)`` with the stored code: ``code``, ``along``, ``rest``."""
    for b in batches:
        dim = np.asarray(b.column(3))
        for d in np.unique(dim):
            part = b.take(pa.array(np.flatnonzero(dim == d)))
            words, along, rest = codes_of(_matrix(part.column(4)).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([w.tobytes() for w in words], pa.binary()), pa.array(along), pa.array(rest)],
                                             names=[*b.schema.names, "code", "along", "rest"])


class Slot:
    """The rows of one slot: codes, labels, ids and exact vectors."""

    def __init__(self, table: pa.Table):
        self.rows, self.labels = (table.column(c).to_numpy() for c in ("row", "label"))
        ids = table.column("id")
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        self.vec = _matrix(table.column("vec"))
        self.codes = np.array([np.frombuffer(c, "<u8") for c in table.column("code").to_pylist()])
        self.along, self.rest = (table.column(c).to_numpy() for c in ("along", "rest"))
        self.ones = np.bitwise_count(self.codes).sum(1).astype(np.float64)
        self.float = self.vec.astype(np.float64)
        self.most = float(np.abs(self.float).max(initial=0.0))

    def scores(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact integer products of the anchor and the rows ``at``."""
        if self.most * float(np.abs(anchor.astype(np.float64)).sum()) < 2.0**53:
            return (self.float[at] @ anchor.astype(np.float64)).astype(np.int64)
        whole = [sum(int(a) * int(b) for a, b in zip(anchor, v, strict=True)) for v in self.vec[at]]
        return np.array(whole, np.int64)

    def order(self, at: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Higher scores first, then smaller ids, null ids last."""
        return np.lexsort((self.rows[at], self.ids[at], self.no_id[at], -score))

    def intervals(self, anchors: np.ndarray):
        """``(at, middle, half)`` for blocks of anchors: the product with each row lies within ``half`` of ``middle``."""
        y = rotated(anchors.astype(np.float64))
        size = y.shape[1]
        words = self.codes.shape[1]
        block = max(1, (1 << 21) // max(1, len(self.rows) * words))
        for s in range(0, len(y), block):
            part = y[s:s + block]
            low, high = part.min(1, initial=np.inf), part.max(1, initial=-np.inf)
            low, high = np.where(np.isfinite(low), low, 0.0), np.where(np.isfinite(high), high, 0.0)
            step = np.maximum((high - low) / (2**PLANES - 1), 1e-12)
            levels = np.rint((part - low[:, None]) / step[:, None]).astype(np.int64)
            err = np.linalg.norm(part - low[:, None] - step[:, None] * levels, axis=1)
            hit = np.zeros((len(part), len(self.rows)))
            for j in range(PLANES):
                plane = _words((levels >> j) & 1 == 1)
                hit += np.bitwise_count(plane[:, None, :] & self.codes[None]).sum(2) * float(1 << j)
            on_code = low[:, None] * (2 * self.ones - size) + step[:, None] * (2 * hit - levels.sum(1)[:, None])
            on_code /= np.sqrt(max(1, size))
            square = (part * part).sum(1)[:, None]
            sure = np.maximum(0.0, np.abs(on_code) - err[:, None])
            half = self.along * err[:, None] + self.rest * np.sqrt(np.maximum(0.0, square - sure * sure))
            slack = 1e-9 * np.sqrt(square) * (self.along + self.rest) + 1e-6
            yield s, self.along * on_code, half + slack


def _first(slot: Slot, anchor: np.ndarray, at: np.ndarray, middle: np.ndarray, half: np.ndarray, bands: list[tuple[int | None, int | None]], k: int):
    """For each band of scores, the first ``k`` of the rows ``at`` within it: ``[(rows, scores)]``.

    The best rows by popcount below the band's top are scored first; a row whose interval ends below their ``k``-th score, or
    starts above the band, is out. What is left is scored."""
    middle, half = middle[at], half[at]
    upper, lower = middle + half, middle - half
    known = np.zeros(len(at), bool)
    score = np.zeros(len(at), np.int64)

    def settle(mask: np.ndarray) -> None:
        new = np.flatnonzero(mask & ~known)
        score[new] = slot.scores(anchor, at[new])
        known[new] = True

    def inside(lo: int | None, hi: int | None) -> np.ndarray:
        ok = known.copy()
        if lo is not None:
            ok &= score >= lo
        if hi is not None:
            ok &= score <= hi
        return ok

    out = []
    for lo, hi in bands:
        if lo is not None and hi is not None and lo > hi:
            out.append((at[:0], score[:0]))
            continue
        able = np.ones(len(at), bool)
        if lo is not None:
            able &= upper >= lo
        if hi is not None:
            able &= lower <= hi
        picks = np.flatnonzero(able)
        if len(picks) > SEEDS:
            gap = -middle[picks] if hi is None else np.abs(middle[picks] - hi)
            picks = picks[np.argpartition(gap, SEEDS)[:SEEDS]]
        seeds = np.zeros(len(at), bool)
        seeds[picks] = True
        settle(seeds)
        best = np.sort(score[inside(lo, hi)])
        if len(best) >= k:
            able &= upper >= best[-k]
        settle(able)
        found = np.flatnonzero(inside(lo, hi))
        found = found[slot.order(at[found], score[found])[:k]]
        out.append((at[found], score[found]))
    return out


def _search(work):
    """A task: one slot of rows and one set of anchors of one length; ``work`` gives the columns for each anchor."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(anchors):
            slot, vec = Slot(rows), _matrix(anchors.column("a_vec"))
            own, labels = anchors.column("a_row").to_numpy(), anchors.column("a_label").to_numpy()
            for s, middle, half in slot.intervals(vec):
                for i in range(len(middle)):
                    out += work(slot, anchors, s + i, own[s + i], labels[s + i], vec[s + i], middle[i], half[i])
        return out

    return run


_POSITIVE = "arow bigint, aid bigint, prow bigint, pid bigint, score bigint"
_NEGATIVE = "arow bigint, aid bigint, prow bigint, pid bigint, pscore bigint, nrow bigint, nid bigint, score bigint"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, cols, strict=True)})


def _positives(k: int):
    def work(slot, anchors, i, own, label, vec, middle, half):
        at = np.flatnonzero((slot.labels == label) & (slot.rows != own))
        (found, score), = _first(slot, vec, at, middle, half, [(None, None)], k)
        aid = anchors.column("a_id")[i].as_py()
        return [(own, aid, slot.rows[r], None if slot.no_id[r] else slot.ids[r], s) for r, s in zip(found, score, strict=True)]

    search = _search(work)
    return lambda rows, anchors: _table(search(rows, anchors), _POSITIVE)


def _negatives(k: int, low: int, high: int):
    def work(slot, anchors, i, own, label, vec, middle, half):
        at = np.flatnonzero(slot.labels != label)
        positives = anchors.column("a_positives")[i].as_py()
        bands = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]  # whole scores: 100 * n between the ends
        aid = anchors.column("a_id")[i].as_py()
        return [(own, aid, p["prow"], p["pid"], p["score"], slot.rows[r], None if slot.no_id[r] else slot.ids[r], s)
                for p, (found, score) in zip(positives, _first(slot, vec, at, middle, half, bands, k), strict=True)
                for r, s in zip(found, score, strict=True)]

    search = _search(work)
    return lambda rows, anchors: _table(search(rows, anchors), _NEGATIVE)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``(row, id, label, dim, vec)`` of the rows that take part; ``vec`` holds whole numbers."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return (vectors.where(x.isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                    F.size(x).alias("dim"), F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("vec")))


def coded(rows: DataFrame) -> DataFrame:
    """``rows`` (columns of ``usable``) with their stored codes."""
    return rows.mapInArrow(_code, "row bigint, id bigint, label bigint, dim int, vec array<bigint>, code binary, along double, rest double")


def hard_negatives(rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of a written table of ``coded`` rows.

    Of the rows of another label, those scoring from ``low`` to ``high`` percent of the positive's score, best first."""
    ship_package(rows.sparkSession)
    anchors = rows.where(is_anchor).select("row", "id", "label", "dim", "vec")
    n_rows, n_anchors = rows.count(), anchors.count()
    slots, sets = max(1, -(-n_rows // SLOT_ROWS)), max(1, -(-n_anchors // SET_ANCHORS))
    dealt = rows.select("*", F.pmod(F.xxhash64("row"), F.lit(slots)).cast("int").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set"))

    def met(chosen: DataFrame, work, schema: str) -> DataFrame:
        # both sides come from one table: columns under new names, or Spark takes one side's for the other's
        to = chosen.select(*[F.col(c).alias(f"a_{c}") for c in chosen.columns], F.pmod(F.xxhash64("row"), F.lit(sets)).cast("int").alias("a_set"),
                           F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("a_slot"))
        return dealt.groupBy("dim", "slot", "set").cogroup(to.groupBy("a_dim", "a_slot", "a_set")).applyInArrow(work, schema)

    def ranked(found: DataFrame, by: list[str], other: str, k: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col(f"{other}id").asc_nulls_last(), f"{other}row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = ranked(met(anchors, _positives(positives), _POSITIVE), ["arow"], "p", positives)
    best = best.groupBy("arow").agg(F.collect_list(F.struct("prow", "pid", "score")).alias("positives"))  # ``positives`` entries at most
    known = saved(anchors.join(best.withColumnRenamed("arow", "row"), "row"))
    found = ranked(met(known, _negatives(negatives, low, high), _NEGATIVE), ["arow", "prow"], "n", negatives)
    return found.select(F.col("aid").alias("anchor_id"), F.col("pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("nid").alias("negative_id"), F.col("pscore").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir):
    ship_package(spark)
    rows = usable(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 256)
    noisy = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(saved(coded(rows.withColumn("label", noisy))), F.col("id") % 100 == 0)


ORACLE = """
WITH usable AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
                FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
                  CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, b.v)]) AS BIGINT) AS score
           FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id, score FROM scored WHERE alike
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
found AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
          FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
           AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""
