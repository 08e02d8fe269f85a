"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words of a text; the model of a later category
also sees the probabilities of the earlier ones. In training these are out-of-fold predictions,
so a later model learns from probabilities of the kind it will meet. A category is a label column and the value
that counts as positive; the labels at hand give two, ``low_quality`` (quality = 0) and ``toxic``, in this order.

Features are word, 5-byte and 4-byte prefix hashes that a text holds; the
``features`` best by chi-square are picked per category from counts made in Spark. Models are fitted on at most ``sample``
labelled rows (a documented bound; as many positives as negatives of the last category if there are
enough, weighted back to their share). Scoring is one map-only pass over whole texts.

Defined results: null and empty texts have no features and get the models' base rate; a category whose labels
lack one class predicts its constant; null labels and ids aren't learnt from; repeated rows get equal results;
an empty table gives an empty result. Other columns are not read unless named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.llm.common import documents, saved
from intakeyard.llm.decontaminate import WORD_BYTES
from intakeyard.llm.quality import fold
from intakeyard.llm.textbytes import RangeHash, blocks_of, mix, text_views
from intakeyard.session import ship_package
from intakeyard.sources.tables import load

SAMPLE, FEATURES, FOLDS = 6_000, 256, 5


@dataclass(frozen=True)
class Category:
    name: str
    label: str
    positive: int = 1


CATEGORIES = (Category("low_quality", "quality", 0), Category("toxic", "toxic", 1))


def word_features(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, feature hash)`` of every word feature of the texts, repeats included."""
    data = np.frombuffer(b"".join(b" " + t.tobytes().translate(WORD_BYTES) for t in texts) + b" ", np.uint8)
    space = data == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(bounds, starts, "right") - 1
    hasher = RangeHash(data)
    words = [hasher.of(starts, ends)] + [mix(hasher.of(starts, np.minimum(starts + k, ends)) + np.uint64(k)) for k in (5, 4)]
    return np.tile(owner, 3), np.concatenate(words)


def _distinct(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    owner, hashes = word_features(texts)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]) if len(owner) else np.empty(0, bool)
    owner, hashes = owner[new], hashes[new]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield hashes[a:b].view(np.int64)


class Vocabulary:
    """The picked features; turns texts into a 0/1 matrix."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.view(np.uint64))
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def matrix(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.hashes)), np.float64)
        if len(self.hashes):
            owner, hashes = word_features(texts)
            likely = self.gate[(hashes >> np.uint64(48)).astype(np.int64)]
            owner, hashes = owner[likely], hashes[likely]
            slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = self.hashes[slot] == hashes
            out[owner[hit], slot[hit]] = 1
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01, steps: int = 15) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression by Newton steps."""
    if len(y) == 0 or y.min() == y.max():
        w = np.zeros(x.shape[1] + 1)
        w[-1] = 0.0 if len(y) == 0 else (10.0 if y[0] else -10.0)
        return w
    z = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (y - p)) - penalty * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hess, grad)
        w += move
        if np.abs(move).max() < 1e-4:
            break
    return w


def predict_logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    categories: tuple[Category, ...]
    vocabulary: Vocabulary
    models: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, labels: list[np.ndarray], weight: np.ndarray, folds: np.ndarray) -> Chain:
        for y in labels:
            self.models.append(fit_logistic(x, y, weight))
            out = np.zeros(len(y))
            for f in range(FOLDS):
                held = folds == f
                out[held] = predict_logistic(x[held], fit_logistic(x[~held], y[~held], weight[~held]))
            x = np.concatenate([x, out[:, None]], 1)
        return self

    def predict(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        x, out = self.vocabulary.matrix(texts), []
        for w in self.models:
            out.append(predict_logistic(x, w))
            x = np.concatenate([x, out[-1][:, None]], 1)
        return out


def fit_chain(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", categories: tuple[Category, ...] = CATEGORIES,
              sample: int = SAMPLE, features: int = FEATURES) -> Chain:
    """Chain learnt from at most ``sample`` labelled rows outside the held-out fold."""
    ship_package(docs.sparkSession)
    named = labels.where(fold(id_col) != 1).select(
        F.col(id_col).alias("id"), *[(F.col(c.label) == c.positive).cast("double").alias(f"y{i}") for i, c in enumerate(categories)]).dropna()
    last = f"y{len(categories) - 1}"
    share = {r[0]: r[1] for r in named.groupBy(last).count().collect()}  # two rows at most
    order = [F.xxhash64("id"), "id", *[f"y{i}" for i in range(len(categories))]]
    chosen = (named.where(F.col(last) == 1).orderBy(*order).limit(sample // 2)
              .union(named.where(F.col(last) == 0).orderBy(*order).limit(sample // 2)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns - 1
            views = list(text_views(b.column(n)))
            for s, e in blocks_of([len(v) for v in views], 4 << 20):
                yield pa.RecordBatch.from_arrays([b.column(i).slice(s, e - s) for i in range(n)] + [
                    pa.array(list(_distinct(views[s:e])), pa.list_(pa.int64()))], names=[*ys, "fold", "features"])

    ys = [f"y{i}" for i in range(len(categories))]
    table = saved(rows.select(*ys, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"), "text").mapInArrow(
        hashed, ", ".join(f"{y} double" for y in ys) + ", fold int, features array<bigint>"))
    total = table.agg(F.count(F.lit(1)), *[F.sum(y) for y in ys]).head()
    counts = table.select(*ys, F.explode("features").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(y) for y in ys]).where("n >= 3")
    picked: set[int] = set()
    for i, y in enumerate(ys):
        n, pos = total[0], total[i + 1] or 0.0
        expected = F.col("n") * F.lit(float(pos) / max(n, 1))
        spread = F.lit(max(1e-9, float(pos) / max(n, 1) * (1 - float(pos) / max(n, 1)))) * F.col("n") * (1 - F.col("n") / F.lit(float(n + 1)))
        best = counts.orderBy(F.desc(F.pow(F.col(y) - expected, F.lit(2)) / spread), "f").limit(features // len(ys))
        picked |= {r.f for r in best.select("f").collect()}
    vocabulary = Vocabulary(np.array(sorted(picked), np.int64))
    wanted = F.array(*[F.lit(int(h)) for h in vocabulary.hashes.view(np.int64)]) if picked else F.array().cast("array<bigint>")
    got = table.select(*ys, "fold", F.array_intersect("features", wanted).alias("f")).toArrow()
    x = np.zeros((got.num_rows, len(vocabulary.hashes)))
    for i, found in enumerate(got.column("f").to_pylist()):
        x[i, np.searchsorted(vocabulary.hashes, np.array(found, np.int64).view(np.uint64))] = 1
    y = [got.column(c).to_numpy() for c in ys]
    folds = got.column("fold").to_numpy()
    order = np.lexsort((*x.T[:32], folds, *y)) if got.num_rows else np.empty(0, int)
    x, y, folds = x[order], [v[order] for v in y], folds[order]
    in_sample = {v: max(1.0, float((y[-1] == v).sum())) for v in (0.0, 1.0)}
    everything = max(1, sum(share.values()))
    weight = np.where(y[-1] == 1, share.get(1.0, 0) / in_sample[1.0], share.get(0.0, 0) / in_sample[0.0]) * len(folds) / everything
    return Chain(categories, vocabulary).fit(x, y, weight, folds)


def toxicity(docs: DataFrame, chain: Chain, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with ``p_<category>`` for each category and ``predicted`` (last category at 0.5 or more)."""
    ship_package(docs.sparkSession)
    added = [T.StructField(f"p_{c.name}", T.DoubleType()) for c in chain.categories] + [T.StructField("predicted", T.IntegerType())]
    carried = [c for c in carry or [] if c.lower() not in {f.name for f in added}]
    source = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"))
    schema = T.StructType([*[source.schema[c] for c in carried], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            views = list(text_views(b.column(b.num_columns - 1)))
            for s, e in blocks_of([len(v) for v in views], 4 << 20):
                p = chain.predict(views[s:e])
                yield pa.RecordBatch.from_arrays([b.column(i).slice(s, e - s) for i in range(len(carried))] + [pa.array(x, pa.float64()) for x in p] + [
                    pa.array((p[-1] >= 0.5).astype(np.int32), pa.int32())], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity(docs, fit_chain(docs, load(spark, sf_dir, "labels")), carry=["doc_id"])
