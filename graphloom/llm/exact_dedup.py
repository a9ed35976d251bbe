"""Exact duplicate removal against history, by minimal perfect hashing.

The distinct digests of history are dealt into buckets.  Each bucket gets a
minimal perfect hash function whose slots hold the full 256-bit digest, the
winner's ``doc_id`` and the number of rows.  A digest of the incoming batch is
hashed to its slot and compared byte by byte with the digest there: equal means
a repeat of the winner; otherwise the digest is new and its rows form a group
of their own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_space, materialise, mix64, table

_GOLD = 0x9E3779B97F4A7C15


class PerfectHash:
    """Minimal perfect hash of distinct 256-bit keys, in levels of collision-free bits.

    At each level a key hashes to one of twice as many places as there are keys
    left; keys alone in their place settle there, the others go on to the next
    level.  The rank of a key's bit among all set bits is its slot, so n keys use
    exactly the slots 0 to n-1.
    """

    def __init__(self, keys: np.ndarray) -> None:
        """``keys``: uint64 array of shape (n, 4) without repeated rows."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        base, left = 0, keys
        while len(left):
            at = self._place(left, len(self.levels), 2 * len(left) + 1)
            bits = np.bincount(at, minlength=2 * len(left) + 1) == 1
            ranks = np.cumsum(bits) - 1 + base
            self.levels.append((bits, ranks))
            base += int(bits.sum())
            left = left[~bits[at]]
        self.size = base

    @staticmethod
    def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
        seed = np.uint64((level + 1) * _GOLD & (2**64 - 1))
        h = mix64(keys[:, 0] ^ seed)
        for k in (1, 2, 3):
            h = mix64(h + keys[:, k])
        return (h % np.uint64(places)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each member; some slot or -1 for any other key."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(self.levels):
            if not len(open_):
                break
            at = self._place(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8").reshape(-1, 4).astype(np.uint64)


def _resolve(history: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
    """One bucket: each distinct digest with the winner and the size of its group."""
    empty = pd.DataFrame({"digest": [], "first_id": [], "n": []}, dtype=object)
    history, batch = (side if len(side) else empty for side in (history, batch))  # an absent side has no columns
    keys, new = _words(history["digest"]), _words(batch["digest"])
    index = PerfectHash(keys)
    place = index.slots(keys)
    digest, winner, rows = np.empty_like(keys), np.empty(len(keys), object), np.empty(len(keys), np.int64)
    digest[place], rows[place] = keys, history["n"].to_numpy()
    winner[place] = history["first_id"].to_numpy()
    slot = index.slots(new)
    member = slot >= 0
    member[member] = (digest[slot[member]] == new[member]).all(axis=1)
    np.add.at(rows, slot[member], batch["n"].to_numpy(np.int64)[member])
    raw = np.empty(len(keys), object)
    raw[place] = history["digest"].to_numpy()
    known = pd.DataFrame({"digest": raw, "keep_id": winner, "group_size": rows})
    fresh = batch.loc[~member, ["digest", "first_id", "n"]].set_axis(["digest", "keep_id", "group_size"], axis=1)
    # A group wholly of null ids has no winner's id.
    out = pd.concat([known, fresh], ignore_index=True)
    return out.assign(keep_id=out["keep_id"].astype("Int64"), group_size=out["group_size"].astype("int64"))


def exact_dedup(
    docs: DataFrame,
    is_history: Column,
    normalise: Callable[[Column], Column] = fold_space,
    bucket_rows: int = 20_000,
) -> DataFrame:
    """Group documents of equal normalised text; history's winner comes before any of the batch.

    ``is_history`` tells the rows of history from those of the batch; ids of
    history must be the smaller ones for the winner to have the smallest id.
    Returns ``doc_id, digest, keep_id, group_size, kept``, one row per document:
    ``keep_id`` is the smallest id of history with that text, or of the batch if
    history hasn't the text; ``kept`` is true where ``doc_id`` is ``keep_id``.

    Null text counts as empty.  Rows with a null id are grouped like others but
    win only a group without any id (then ``keep_id`` is null and they are kept).
    Rows that repeat an id and its text share their fate.  An empty table gives
    no rows.  Columns other than ``doc_id`` and ``text`` are not read.

    Scale: the text is read once; distinct digests are pre-aggregated before the
    shuffle, so a bucket holds about ``bucket_rows`` digests whatever the sizes
    of groups; rows meet their group in a join whose hot digests AQE splits.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalise(F.col("text")), 256)).alias("digest"),
        F.coalesce(is_history, F.lit(False)).alias("old"),
    )
    rows = materialise(rows, "digests")
    size = F.count(F.lit(1)).alias("n")
    first = F.min("doc_id").alias("first_id")
    n_buckets = max(64, -(-rows.count() // bucket_rows))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).alias("bucket")
    old = rows.where("old").groupBy("digest").agg(first, size).select(bucket, "*")
    new = rows.where("NOT old").groupBy("digest").agg(first, size).select(bucket, "*")
    # Fresh attributes: sides of a cogroup that share some lose columns when later ones are pruned.
    new = new.select(*(F.col(c).alias(c) for c in new.columns))
    groups = (
        old.groupBy("bucket")
        .cogroup(new.groupBy("bucket"))
        .applyInPandas(_resolve, "digest binary, keep_id long, group_size long")
    )
    return rows.join(groups, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def history_half(docs: DataFrame) -> Column:
    """The rows with ids in the lower half of the range stand for what earlier runs have kept."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return F.col("doc_id") < F.lit(0 if low is None else low + (high - low + 1) // 2)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: the lower half of the ids is history, the upper half the batch."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, history_half(docs)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
