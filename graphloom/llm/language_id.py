"""Language identification by the nearest of several centroids per language.

Texts are TF-IDF vectors of letter trigrams, of unit length.  Spherical k-means
splits each language's sample into clusters; a text gets the language of the
centroid with the highest cosine.  One that is far from all of them is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import table
from .sparse_text import ANY_LETTER, Sparse, bounded_sample, collect_sparse, id_hash_mod, letter_grams, map_texts

#: Documents learned from, of each language at most.
TRAIN_PER_LANGUAGE = 600
CENTROIDS = 4


@dataclass
class CentroidModel:
    """Inverse document frequencies, unit centroids by column, each one's language, and the least cosine accepted."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: float

    def nearest(self, x: Sparse) -> tuple[str | None, float]:
        at, tf = x
        if not self.languages:
            return None, 0.0
        value = tf * self.idf[at]
        length = float(np.sqrt(value @ value))
        cosine = value @ self.centroids[at] / (length or 1.0)
        best = int(np.argmax(cosine))
        return self.languages[best], float(np.clip(cosine[best], 0, 1))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Unit centroids of unit ``rows``; the first is the mean, each further start the row farthest from those before."""
    starts = [_unit(rows.mean(axis=0))]
    while len(starts) < min(k, len(rows)):
        starts.append(rows[np.argmin((rows @ np.stack(starts).T).max(axis=1))])
    centroids = np.stack(starts)
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        centroids = np.stack([_unit(rows[nearest == c].mean(axis=0)) if (nearest == c).any() else centroids[c] for c in range(len(centroids))])
    return centroids


def fit(sample: list[tuple[object, Sparse]], bits: int = 13, k: int = CENTROIDS) -> CentroidModel:
    """Model of (language, counts) pairs; the least cosine accepted is half of that of the worst hundredth."""
    df = np.zeros(1 << bits)
    for _, (at, _) in sample:
        df[at] += 1
    idf = np.log((1 + len(sample)) / (1 + df)) + 1
    columns, languages, own = [], [], []
    for language in sorted({str(name) for name, _ in sample}):
        chosen = [x for name, x in sample if name == language and len(x[0])]
        rows = np.zeros((len(chosen), 1 << bits), np.float32)
        for i, (at, tf) in enumerate(chosen):
            rows[i, at] = tf * idf[at]
        if not len(rows):
            continue
        rows = _unit(rows)
        found = spherical_kmeans(rows, k)
        own.append((rows @ found.T).max(axis=1))
        columns.append(found)
        languages += [language] * len(found)
    least = float(np.quantile(np.concatenate(own), 0.01)) / 2 if own else 0.0
    table_ = np.concatenate(columns).T if columns else np.zeros((1 << bits, 0))
    return CentroidModel(idf, np.ascontiguousarray(table_, np.float64), languages, least)


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> CentroidModel:
    """Fit on at most ``per_language`` documents of each language (non-null ``lang``), drawn by a seeded hash of the id."""
    ship(docs.sparkSession)
    tagged = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = bounded_sample(tagged.select("doc_id", "lang"), "lang", per_language).dropDuplicates(["doc_id"])
    sample = tagged.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return fit(collect_sparse(sample, "lang", letter_grams))


def identify(docs: DataFrame, model: CentroidModel, unknown: str = "und") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every document, from its whole text.

    ``score`` is the cosine to the nearest centroid.  A text that is null or has
    no letter is ``unknown`` with score 0 and rejected, as is every text under a
    model of no language.  A text whose score is under the model's least cosine is
    rejected too, but still named.  Null and repeated ids are treated like
    others; an empty table gives no rows; other columns aren't read.
    """
    ship(docs.sparkSession)

    def name(text: str | None) -> tuple[str, float, bool]:
        if not text or not ANY_LETTER.search(text):
            return unknown, 0.0, True
        language, cosine = model.nearest(letter_grams(text))
        return language or unknown, cosine, language is None or cosine < model.least

    return map_texts(docs, name, "lang_pred string, score double, rejected boolean")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by a model of those whose id's hash isn't 1 modulo 3."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_hash_mod(F.col("doc_id"), 3) == 1
    model = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    return identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
