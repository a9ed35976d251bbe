"""Quality classifier: ordinal regression with cumulative links over hashed text.

One weight vector w and ordered thresholds t_1 < ... < t_(K-1) serve all K
grades: P(grade > k) = sigmoid(w.x - t_k).  From it follow the expected grade
and the probability of at least a wanted grade, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import table
from .sparse_text import Sparse, bounded_sample, byte_grams, collect_sparse, map_texts

#: Labelled documents learned from, of each grade at most.
TRAIN_PER_GRADE = 900
#: A document stays if its grade is above the lowest with this probability: clean ones are rarely lost.
KEEP_FROM = 0.15


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Grades in rising order, weights by bucket, thresholds between neighbouring grades."""

    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, x: Sparse) -> np.ndarray:
        """P(grade > k-th grade) for all grades but the last."""
        at, value = x
        return _sigmoid(float(self.weights[at] @ value) - self.thresholds)

    def assess(self, x: Sparse, least: int) -> tuple[float, float]:
        """Expected grade, and probability of the ``least``-th grade (from 0) or a higher one."""
        tails = self.tails(x)
        expected = self.grades[0] + float(np.diff(self.grades) @ tails)
        return expected, 1.0 if least <= 0 else float(tails[least - 1])


def fit(sample: list[tuple[object, Sparse]], bits: int = 15, l2: float = 1e-4, steps: int = 200, rate: float = 0.3) -> OrdinalModel:
    """Maximum likelihood by full-gradient Adam, grades weighted evenly.

    Thresholds are the first one and the logs of the gaps, so they stay ordered.
    Without labels, or with one grade, all weights are zero.
    """
    grades = sorted({float(g) for g, _ in sample}) or [0.0]
    k = len(grades) - 1
    weights = np.zeros(1 << bits)
    if k < 1:
        return OrdinalModel(grades, weights, np.zeros(0))
    y = np.array([grades.index(float(g)) for g, _ in sample])
    at = np.concatenate([x[0] for _, x in sample]).astype(np.int64)
    value = np.concatenate([x[1] for _, x in sample])
    row = np.repeat(np.arange(len(sample)), [len(x[0]) for _, x in sample])
    share = 1 / np.bincount(y, minlength=k + 1)[y]
    share /= share.sum()
    theta = np.zeros(k)  # first threshold, then logs of gaps
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros(k), np.zeros(k)]
    for step in range(1, steps + 1):
        t = np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])
        z = np.bincount(row, weights[at] * value, minlength=len(sample))
        above = _sigmoid(z[:, None] - t)  # P(grade > k)
        bound = np.hstack([np.ones((len(z), 1)), above, np.zeros((len(z), 1))])
        slope = bound * (1 - bound)
        i = np.arange(len(z))
        p = np.maximum(bound[i, y] - bound[i, y + 1], 1e-12)
        dz = -share * (slope[i, y] - slope[i, y + 1]) / p
        dt = np.zeros((len(z), k + 2))
        dt[i, y] += share * slope[i, y] / p
        dt[i, y + 1] -= share * slope[i, y + 1] / p
        dt = dt[:, 1:-1].sum(axis=0)
        gaps = np.exp(theta[1:])
        d_theta = np.concatenate([[dt.sum()], [dt[j + 1 :].sum() * gaps[j] for j in range(k - 1)]])
        d_w = np.bincount(at, dz[row] * value, minlength=len(weights)) + l2 * weights
        for x, d, (m, v) in ((weights, d_w, moments[:2]), (theta, d_theta, moments[2:])):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    t = np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])
    return OrdinalModel(grades, weights, t)


def train(docs: DataFrame, labels: DataFrame, grade: str = "quality", per_grade: int = TRAIN_PER_GRADE) -> OrdinalModel:
    """Fit on at most ``per_grade`` labelled documents of each grade, drawn by a seeded hash of the id."""
    ship(docs.sparkSession)
    rated = labels.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull())
    rated = rated.select("doc_id", F.col(grade).cast("double").alias("_grade"))
    ids = bounded_sample(rated, "_grade", per_grade).dropDuplicates(["doc_id"])
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return fit(collect_sparse(sample, "_grade", byte_grams))


def assess(docs: DataFrame, model: OrdinalModel, least: int | None = None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, expected_grade, tail_prob, kept`` for every document, from its whole text.

    ``tail_prob`` is the probability of the ``least``-th grade or better (by
    default the second lowest); ``kept`` is whether it reaches ``keep_from``.
    A null or empty text has the empty vector: thresholds alone decide.  Null and
    repeated ids are assessed like others, an empty table gives no rows; other
    columns aren't read.
    """
    ship(docs.sparkSession)
    at_least = min(1, len(model.grades) - 1) if least is None else least

    def judge(text: str | None) -> tuple[float, float, bool]:
        expected, tail = model.assess(byte_grams(text or ""), at_least)
        return expected, tail, tail >= keep_from

    return map_texts(docs, judge, "expected_grade double, tail_prob double, kept boolean")


def keep_good(docs: DataFrame, model: OrdinalModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`assess` would keep."""
    ship(docs.sparkSession)
    at_least = min(1, len(model.grades) - 1)
    text = docs.columns.index("text")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [model.assess(byte_grams(t or ""), at_least)[1] >= keep_from for t in b.column(text).to_pylist()]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(select, docs.schema)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by a model of the ratings in ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return assess(docs, train(docs, table(spark, sf_dir, "labels")))
