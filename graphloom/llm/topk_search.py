"""Exact nearest vectors by inner product, with Fagin's threshold algorithm.

Candidates lie in blocks.  A block keeps, for each dimension, its vectors sorted
by that component.  A query walks all lists at once from its best end; the
vectors it meets are scored in full.  What it hasn't met can't score more than
the bound: the inner product of the query with the components at the lists'
current depth.  It stops when the bound is less than its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import table

HITS = "query_id long, vec_id long, score long"


class SortedLists:
    """A block of integer vectors with each dimension's order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")  # ties then go to the smaller id
        self.ids = ids[by_id]
        # Sums of products stay far below 2**53 for components below 2**20: doubles hold them exactly.
        exact = np.abs(vectors).max(initial=0) < 1 << 20
        self.vectors = np.ascontiguousarray(vectors[by_id], np.float64 if exact else np.int64)
        self.order = np.ascontiguousarray(np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32))

    def top(self, query: np.ndarray, k: int, own: int, first_depth: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors other than ``own``; equal scores by id."""
        n = len(self.vectors)
        query = query.astype(self.vectors.dtype)
        used = np.flatnonzero(query)
        down, up = used[query[used] > 0], used[query[used] < 0]
        open_ = self.ids != own
        places, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, step = 0, first_depth
        while depth < n:
            end = min(n, depth + step)
            met = np.zeros(n, bool)
            if len(used):
                met[self.order[down, n - end : n - depth].ravel()] = True
                met[self.order[up, depth:end].ravel()] = True
            else:
                met[:] = True
            met &= open_
            open_ &= ~met
            fresh = np.flatnonzero(met)
            seen = self.vectors[fresh] @ query
            if len(scores) == k:  # only what beats or ties the k-th best matters
                good = seen >= scores.min()
                fresh, seen = fresh[good], seen[good]
            elif len(seen) > 4 * k:
                good = seen >= np.partition(seen, -k)[-k]
                fresh, seen = fresh[good], seen[good]
            places, scores = np.concatenate([places, fresh]), np.concatenate([scores, seen])
            best = np.lexsort((places, -scores))[:k]
            places, scores = places[best], scores[best]
            bound = self.vectors[self.order[down, n - end], down] @ query[down]
            bound += self.vectors[self.order[up, end - 1], up] @ query[up]
            if len(scores) == k and bound < scores.min():
                break
            depth, step = end, step * 2
        return self.ids[places], scores.astype(np.int64)


def quantise(vector: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component as long; null for a vector that is null, holds null or isn't finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(vector.isNotNull() & ~bad, whole)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in column])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    block_rows: int = 8192,
    query_rows: int = 4096,
) -> DataFrame:
    """For each query row its ``k`` best other rows: ``query_id, rank, vec_id, score``.

    Vectors (``vec_id``, ``embedding``: integers) that are null take no part.
    Vectors meet those of their own length only.  Ties go to the smaller
    ``vec_id``; rows that share a query's id are not its candidates.  A null id
    takes no part.  Fewer than ``k`` candidates give fewer rows.  Rows that repeat
    a query's id are ranked together; a candidate that repeats an id is ranked as
    often.  An empty table gives no rows; other columns aren't read.

    Scale: a grid of blocks of queries and of candidates, each cell a task of
    bounded memory; a cell returns ``k`` rows per query.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").alias("v"),
        F.size("embedding").alias("dims"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("vec_id IS NOT NULL AND v IS NOT NULL")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-asked // query_rows))
    spread = F.shiftrightunsigned(F.xxhash64("vec_id"), 1)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select(
        "vec_id", "v", "dims", (spread % blocks).cast("int").alias("block"), every(groups).alias("group")
    )
    queries = rows.where("asks").select(
        *(F.col(c).alias(c) for c in ("vec_id", "v", "dims")), every(blocks).alias("block"), (spread % groups).cast("int").alias("group")
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        lists = SortedLists(left["vec_id"].to_numpy(np.int64), _stack(left["v"]))
        out = []
        for own, v in zip(right["vec_id"], right["v"], strict=True):
            ids, scores = lists.top(np.asarray(v, np.int64), k, own)
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
        return pd.concat(out, ignore_index=True)

    cell = ["dims", "block", "group"]
    hits = candidates.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInPandas(search, HITS)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with ids divisible by 100 against all others, components floored at 1/1024."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.select("vec_id", quantise(F.col("embedding")).alias("embedding"))
    return top_k(rows, F.col("vec_id") % 100 == 0)


OP9_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
