"""Quality classifier by Bradley-Terry pairwise ranking.

Each text becomes a few surface measures (repetition, case, symbols, word shape, lines). A
labelled sample of at most ``sample`` rows (documented bound, taken in hash order of the id)
gives preference pairs (a good text over a bad one); the weights maximise the likelihood of
``sigmoid(w . (x_good - x_bad))`` by Newton steps, so no intercept is learnt. The ranking
score is then cut at the score quantile that leaves the sample's share of bad rows below it, and
``score = sigmoid(ranking score - cut)``, so 0.5 is the threshold. Scoring is one map-only pass.

Inputs of a score are the text alone. Defined results: null and empty texts are measured as
empty and scored like any other; rows without both classes in the labels give 0.5 to every text;
repeated labels count as often as they occur, null labels not at all; repeated rows get equal scores;
an empty table gives an empty result.
"""

from __future__ import annotations

import operator as op
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm.common import documents
from intakeyard.llm.textbytes import text_views
from intakeyard.session import ship_package
from intakeyard.sources.tables import load

#: Bound of the labelled rows a model is fitted on, and of the preference pairs made of them.
SAMPLE, PAIRS = 20_000, 60_000

_CLASS = np.full(256, 5)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:'\"-()")):
    _CLASS[list(_chars)] = _i
_CLASS[128:] = 6
_MEASURES = 17


def measures(view: np.ndarray) -> list[float]:
    """Surface measures of one text (UTF-8 bytes); all bounded, all zero for an empty text."""
    n = len(view)
    if n == 0:
        return [0.0] * _MEASURES
    by_byte = np.bincount(view, minlength=256)
    lower, upper, digit, _space, point, symbol, high = (np.bincount(_CLASS, by_byte, 7) / n).tolist()
    raw = view.tobytes()
    words = raw.split()
    k = max(1, len(words))
    counts = Counter(words)
    same = sum(map(op.eq, words, words[1:])) / k
    pairs = len(set(zip(words, words[1:], strict=False))) / k
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    commonest = max(counts.values(), default=0) / k
    share = by_byte[by_byte > 0] / n
    spread = float(-(share * np.log(share)).sum()) / 5.55
    letters = lower + upper + high
    return [min(1.0, np.log1p(len(words)) / 12), len(counts) / k, same, pairs, commonest, upper / max(letters, 1e-9), digit, point,
            symbol, high, 1 - letters, len(set(lines)) / m, min(1.0, n / m / 2000), min(1.0, (n - len(words)) / k / 20), spread,
            by_byte[ord("|")] / k, (by_byte[ord("!")] + by_byte[ord("*")] + by_byte[ord("#")] + by_byte[ord("%")]) / k]


def expand(x: np.ndarray) -> np.ndarray:
    """Measures, their squares and their distances from the middle: lets a linear score bend."""
    return np.concatenate([x, x * x, np.sqrt(np.abs(x))], axis=1)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of at most ``sample`` labelled rows."""
    ship_package(docs.sparkSession)
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1) AND id IS NOT NULL")
              .orderBy(F.xxhash64("id"), "id", "y").limit(sample))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [measures(v) for v in text_views(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.mapInArrow(run, "y int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, _MEASURES)
    y = np.array(got.column("y").to_pylist(), int)
    order = np.lexsort((*x.T, y)) if len(y) else np.empty(0, int)
    return x[order], y[order]


class BradleyTerry:
    """Weights, scale and cut of the pairwise ranking; plain numbers, sent to the tasks as they are."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, steps: int = 25):
        self.fitted = len(y) > 0 and 0 < y.sum() < len(y)
        if not self.fitted:
            return
        z = expand(x)
        self.mean, self.scale = z.mean(0), z.std(0) + 1e-9
        z = (z - self.mean) / self.scale
        good, bad = z[y == 1], z[y == 0]
        n = min(pairs, 8 * max(len(good), len(bad)))
        diff = good[np.arange(n) * 7919 % len(good)] - bad[np.arange(n) * 104729 % len(bad)]
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
            grad = diff.T @ (1 - p) / n - ridge * w
            hess = (diff * (p * (1 - p))[:, None]).T @ diff / n + ridge * np.eye(len(w))
            move = np.linalg.solve(hess, grad)
            w += move
            if np.abs(move).max() < 1e-6:
                break
        self.w = w
        s = np.sort(z @ w)
        k = int((y == 0).sum())
        self.cut = (s[k - 1] + s[k]) / 2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), 0.5)
        z = (expand(x) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.w - self.cut, -30, 30)))


def quality_scores(docs: DataFrame, model: BradleyTerry, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with ``score`` and ``predicted`` (score >= 0.5); added names win over carried ones."""
    ship_package(docs.sparkSession)
    carried = [c for c in carry or [] if c.lower() not in ("score", "predicted")]
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"))
    schema = T.StructType([*[source.schema[c] for c in carried], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([measures(v) for v in text_views(b.column(b.num_columns - 1))], float).reshape(-1, _MEASURES)
            s = model.scores(x)
            cols = [b.column(i) for i in range(len(carried))] + [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def fold(id_col: str):
    """Remainder by 3 of the CRC-32 of the id as text; fold 1 is never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                sample: int = SAMPLE) -> BradleyTerry:
    """Ranking model learnt from the labels outside the held-out fold."""
    return BradleyTerry(*training_rows(docs, labels.where(fold(id_col) != 1), id_col, text_col, label_col, sample))


def op1_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit_quality(docs, load(spark, sf_dir, "labels"))
    return quality_scores(docs, model, carry=["doc_id"]).select(
        "doc_id", (fold("doc_id") == 1).alias("held_out"), "score", "predicted")
