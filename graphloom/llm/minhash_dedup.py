"""Near-duplicate detection by a multi-index Hamming join of MinHash signatures.

A signature is ``CHUNKS`` chunks of four components of 32 bits, nothing else.  Two
signatures that differ in fewer than ``2 * CHUNKS`` components have, by the
pigeonhole principle, a chunk with one difference at most; each chunk is
therefore indexed four times, one component left out each time, and equal keys
find all such pairs.  The threshold on the signatures' distance
(:func:`farthest`) is never above that, so the index misses no pair under it.
Those pairs are candidates; links are confirmed on the full sets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ship import ship
from .common import broadcast_if, materialise, mix64, table, window_hashes, word_hashes
from .components import connected_components

CHUNKS, WIDTH = 14, 4
COMPONENTS = CHUNKS * WIDTH
#: Chance that a pair just as similar as asked differs in too many components to be a candidate, where the index allows that.
MISS = 1e-7
#: Signatures that share a key and are compared with each other; those of a key with more are all candidates.
KEY_ROWS = 512
#: Sets of a candidate class compared in one task; a larger class is dealt out.
CLASS_ROWS = 512
#: Sets of a large class that all its tasks get.
LEADERS = 8
_MULTIPLY = mix64(np.arange(1, COMPONENTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ADD = mix64(np.arange(1001, COMPONENTS + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words, A-Z folded; with fewer words the whole text is one."""
    words = word_hashes(text.encode("utf-8", "surrogatepass"), lower=True)
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(words, min(size, len(words))))


def signature(hashes: np.ndarray) -> np.ndarray:
    """For each component the least of the set's hashes under one multiply-and-add, upper 32 bits."""
    out = np.empty(len(_MULTIPLY), np.uint32)
    for i, (m, a) in enumerate(zip(_MULTIPLY, _ADD, strict=True)):
        out[i] = ((hashes * m + a) >> np.uint64(32)).min()
    return out


def keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of n signatures, shape (n, chunks * width): per chunk and component left out one."""
    s = mix64(signatures.astype(np.uint64).reshape(-1, CHUNKS, WIDTH) + (np.arange(WIDTH, dtype=np.uint64) << np.uint64(32)))
    rest = s.sum(axis=2, keepdims=True) - s
    name = mix64(np.arange(1, CHUNKS * WIDTH + 1, dtype=np.uint64)).reshape(CHUNKS, WIDTH)
    return mix64(rest ^ name).reshape(len(signatures), -1)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, on sorted arrays of distinct hashes."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large or not small:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


class Clusters:
    """Disjoint sets of 0..n-1 as an array of labels, for vectorised questions."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]

    def apart(self, i: int, js: np.ndarray) -> np.ndarray:
        """Those of ``js`` that aren't with ``i``."""
        return js[self.label[js] != self.label[i]]


def _sets_of(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_hash, signature`` of each document; empty sets have neither hash nor signature."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, whole, marks = [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text or "", size)
                counts.append(len(s))
                if len(s):
                    pair = np.array([mix64(s).sum(), mix64(s ^ np.uint64(0xABCDEF0123456789)).sum()], "<u8")
                    whole.append(pair.tobytes())
                    marks.append(signature(s).astype("<u4").tobytes())
                else:
                    whole.append(None)
                    marks.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(whole, pa.binary()), pa.array(marks, pa.binary())], ["doc_id", "n_shingles", "set_hash", "signature"])

    return docs.mapInArrow(scan, "doc_id long, n_shingles long, set_hash binary, signature binary")


def _keyed(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                signs = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(b.num_rows, -1)
                k = keys(signs)
                node = np.repeat(b.column(0).to_numpy(), k.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel().view(np.int64)), pa.array(node)], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def farthest(percent: int) -> int:
    """Most components in which a candidate pair may differ: the binomial quantile that leaves ``MISS``, or as many as the index guarantees."""
    p, n, left, k = 1 - percent / 100, COMPONENTS, 1.0, -1
    while left > MISS:
        k += 1
        left -= math.comb(n, k) * p**k * (1 - p) ** (n - k)
    return min(k, 2 * CHUNKS - 1)


def miss(percent: int) -> float:
    """Chance that a pair just as similar as asked is no candidate."""
    p, n = 1 - percent / 100, COMPONENTS
    return sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(farthest(percent) + 1, n + 1))


def _close(signatures: np.ndarray, i: int, most: int) -> np.ndarray:
    """Rows after ``i`` that differ from it in ``most`` components at most."""
    far = (signatures[i + 1 :] != signatures[i]).sum(axis=1)
    return np.flatnonzero(far <= most) + i + 1


def _forest_of_keys(most: int):
    """Candidate links of each key: of the close pairs, enough to join what they join."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "node"], kind="stable")
        key, node = rows["key"].to_numpy(np.int64), rows["node"].to_numpy(np.int64)
        signs = np.frombuffer(b"".join(rows["signature"]), "<u4").reshape(len(rows), -1)
        edges = np.append(np.flatnonzero(np.diff(key, prepend=key[0] - 1)), len(key))
        out: set[tuple[int, int]] = set()
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            clusters = Clusters(b - a)
            for i in range(b - a - 1):
                near = clusters.apart(i, _close(signs[a:b], i, most))
                while len(near):
                    clusters.join(i, near[0])
                    out.add((int(node[a + i]), int(node[a + near[0]])))
                    near = clusters.apart(i, near)
        return pd.DataFrame(sorted(out), columns=["a", "b"]).astype("int64")

    return run


def candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` whose components hold every pair of ``nodes`` that shares a key and is close."""
    keyed = _keyed(nodes)
    shared = keyed.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = materialise(shared.where("head < last").select("key", "head", "n"), "shared-keys")
    met = keyed.join(broadcast_if(shared), "key")
    stars = met.where((F.col("n") > KEY_ROWS) & (F.col("head") != F.col("node"))).select(F.col("head").alias("a"), F.col("node").alias("b"))
    tasks = max(64, -(-shared.count() // 2_000))
    few = met.where(F.col("n") <= KEY_ROWS).select("key", "node").join(nodes.select("node", "signature"), "node")
    close = few.groupBy(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task")).applyInPandas(_forest_of_keys(farthest(percent)), "a long, b long")
    return materialise(stars.unionByName(close).distinct(), "candidates")


def _with_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """Members of candidate classes with their sets, each read from its text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t or "", size).astype("<u8").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), *b.columns[2:]], ["node", "hashes", "class", "n", "signature"])

    rows = docs.join(broadcast_if(members), F.col("doc_id") == F.col("node")).select("doc_id", "text", "class", "n", "signature")
    return rows.mapInArrow(run, "node long, hashes binary, class long, n long, signature binary")


def _confirm(percent: int, asking: bool = False):
    """Links between the sets of a task that join what is not joined yet.

    ``asking``: only between rows that ask and rows that don't or ask later.
    """

    most = farthest(percent)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        node, group = rows["node"].to_numpy(np.int64), rows["class"].to_numpy(np.int64)
        sets = [np.frombuffer(h, "<u8") for h in rows["hashes"]]
        signs = np.frombuffer(b"".join(rows["signature"]), "<u4").reshape(len(rows), -1)
        asks = rows["asks"].to_numpy(bool) if asking else np.ones(len(rows), bool)
        known = rows["cluster"].to_numpy(np.int64) if asking else node
        out: list[tuple[int, int]] = []
        for c in np.unique(group):
            at = np.flatnonzero(group == c)
            clusters = Clusters(len(at))
            if asking:  # what is joined already
                _, clusters.label = np.unique(known[at], return_inverse=True)
            for i in range(len(at) - 1):
                near = clusters.apart(i, _close(signs[at], i, most))
                near = near if asks[at[i]] else near[asks[at[near]]]
                while len(near):
                    x, y = int(at[i]), int(at[near[0]])
                    if linked(sets[x], sets[y], percent):
                        clusters.join(i, near[0])
                        out.append((int(node[x]), int(node[y])))
                    near = clusters.apart(i, near[1:])
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Documents whose sets of ``size``-word shingles have a Jaccard similarity of
    ``percent`` hundredths or more are linked; ``component_id`` is the smallest id
    reachable, ``kept`` is true for that document.  Equal sets are linked.

    Null and empty texts have the empty set and are alone.  A null id is linked
    to nothing: its component is null and it is kept.  Rows that share an id share
    its links.  An empty table gives no rows; other columns aren't read.

    Exactness: links are confirmed on the full sets, and confirmation covers all
    pairs of a candidate class that no confirmed link joins already.  The index
    finds every pair under the threshold on signatures; a pair just as similar as
    asked is above it with the chance :func:`miss` (under 1e-6 at 0.8 and 0.85).

    Scale: equal sets count as one from the start.  Candidates meet through keys
    by minima, never as all pairs.  Each candidate's set is shuffled once; classes
    of more than ``CLASS_ROWS`` sets are dealt to several tasks that share some
    leaders, and only what is then outside the largest cluster is compared with
    the rest.
    """
    ship(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = materialise(_sets_of(slim, size), "sets")
    nodes = sets.where("set_hash IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"))
    nodes = materialise(nodes, "nodes")
    classes = connected_components(candidates(nodes, percent)).select("node", F.col("component").alias("class"))
    sizes = classes.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    members = classes.join(sizes, "class").join(nodes.select("node", "signature"), "node").select("node", "class", "n", "signature")
    members = materialise(members, "members")
    full = materialise(_with_sets(slim, members, size), "candidate-sets")

    seat = F.pmod(F.xxhash64(F.lit(3), "node"), F.ceil(F.col("n") / CLASS_ROWS))
    small = full.where(F.col("n") <= CLASS_ROWS)
    large = full.where(F.col("n") > CLASS_ROWS)
    tasks = max(64, -(-members.count() // 400))
    dealt = small.select("node", "hashes", "signature", "class", F.pmod(F.xxhash64("class"), F.lit(tasks)).alias("task"), F.lit(0).cast("long").alias("seat"))
    spread = large.select("node", "hashes", "signature", "class", F.lit(-1).cast("long").alias("task"), seat.alias("seat"))
    first = W.partitionBy("class").orderBy(F.xxhash64(F.lit(11), "node"), "node")
    chosen = members.where(F.col("n") > CLASS_ROWS).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= LEADERS).select("node")
    leaders = large.join(broadcast_if(materialise(chosen, "leaders")), "node", "left_semi")
    copies = leaders.select("node", "hashes", "signature", "class", F.lit(-1).cast("long").alias("task"), F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / CLASS_ROWS) - 1)).alias("seat"))
    spread = spread.unionByName(copies).dropDuplicates(["node", "seat"])
    found = dealt.groupBy("task").applyInPandas(_confirm(percent), "a long, b long")
    found = found.unionByName(spread.groupBy("class", "seat").applyInPandas(_confirm(percent), "a long, b long"))
    found = materialise(found, "links")
    links = found
    if large.limit(1).count():
        links = found.unionByName(_outside(large, found, percent))
    components = connected_components(links)
    named = sets.join(nodes.select("set_hash", "node"), "set_hash", "left").join(components, "node", "left")
    own = F.coalesce("component", "node", "doc_id")
    return named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _outside(large: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links in large classes between what lies outside the class's largest cluster and the rest, in blocks."""
    clusters = large.select("node", "class", "n").join(connected_components(found), "node", "left")
    clusters = materialise(clusters.select("node", "class", "n", F.coalesce("component", "node").alias("cluster")), "clusters")
    counts = clusters.groupBy("class", "cluster").agg(F.count(F.lit(1)).alias("k"))
    main = counts.groupBy("class").agg(F.max_by("cluster", F.struct("k", "cluster")).alias("main"), F.sum("k").alias("n"), F.max("k").alias("k"))
    main = main.where("k < n").select("class", "main", F.ceil((F.col("n") - F.col("k")) / CLASS_ROWS).alias("blocks"), F.ceil(F.col("n") / CLASS_ROWS).alias("rows"))
    rows = large.select("node", "hashes", "signature", "class").join(clusters.select("node", "cluster"), "node").join(broadcast_if(materialise(main, "main")), "class")
    rows = rows.withColumn("outside", F.col("cluster") != F.col("main"))
    h = F.xxhash64(F.lit(29), "node")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asks = rows.where("outside").select("node", "hashes", "signature", "class", "cluster", F.lit(True).alias("asks"), F.pmod(h, F.col("blocks")).alias("block"), every(F.col("rows")).alias("part"))
    rest = rows.select("node", "hashes", "signature", "class", "cluster", F.lit(False).alias("asks"), every(F.col("blocks")).alias("block"), F.pmod(h, F.col("rows")).alias("part"))
    return asks.unionByName(rest).groupBy("class", "block", "part").applyInPandas(_confirm(percent, True), "a long, b long")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by three-word shingles at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM words
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * c >= 85 * (nx + ny - c)),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sets
  UNION SELECT links.y, reached.root FROM reached JOIN links ON links.x = reached.doc_id WHERE reached.root < links.y
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM sets JOIN reached USING (doc_id) GROUP BY doc_id, s
"""
