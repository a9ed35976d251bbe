"""Hashed n-gram vectors of whole texts, and bounded samples to learn from."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if, materialise

ANY_LETTER = re.compile(r"[^\W\d_]")
_GRAM = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
Sparse = tuple[np.ndarray, np.ndarray]


def _hashed(units: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket (0 to 2**bits - 1) of each run of ``n`` units."""
    m = len(units) - n + 1
    if m <= 0:
        return np.empty(0, np.uint32)
    h = units[:m] * _GRAM[0]
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) + units[k : m + k] * _GRAM[k]
    h ^= h >> np.uint32(16)
    return (h * _GRAM[1]) >> np.uint32(32 - bits)


def _counts(buckets: np.ndarray, bits: int) -> Sparse:
    """Buckets that occur, and 1 + log of how often."""
    count = np.bincount(buckets, minlength=1 << bits)
    at = np.flatnonzero(count)
    return at.astype(np.int32), 1 + np.log(count[at])


def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)


_LETTERS: list[np.ndarray] = []


def letter_grams(text: str, n: int = 3, bits: int = 13) -> Sparse:
    """Counts of n-grams of lower-cased letters; runs of anything else are one gap. Not normalised."""
    if not _LETTERS:
        _LETTERS.append(_is_letter())
    units = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    units = np.where(_LETTERS[0][np.minimum(units, 0xFFFF)], units, 0).astype(np.uint32)
    gap = units == 0
    keep = np.ones(len(units), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    framed = np.concatenate([np.zeros(1, np.uint32), units[keep], np.zeros(1, np.uint32)])
    return _counts(_hashed(framed, n, bits), bits)


def byte_grams(text: str, n: int = 3, bits: int = 15) -> Sparse:
    """Counts of n-grams of UTF-8 bytes as written, as shares (times 20) of all: short texts weigh as much as long ones."""
    at, value = _counts(_hashed(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32), n, bits), bits)
    return at, 20 * value / max(float(value.sum()), 1e-12)


def bounded_sample(rows: DataFrame, group: str, per_group: int, key: str = "doc_id", seed: int = 5) -> DataFrame:
    """At most ``per_group`` rows of each group, by a seeded hash of ``key``.

    The hash is first cut off where, by the group's number of rows, some twice as
    many as wanted are left, so a window sees a bounded number of them however
    many rows and partitions there are.
    """
    drawn, place = F.xxhash64(F.lit(seed), key), 1 << 40
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_size"))
    few = rows.join(broadcast_if(materialise(sizes, "sizes")), F.col(group) == F.col("_group"))
    few = few.where(F.pmod(drawn, F.lit(place)) * F.col("_size") < F.lit(float(place)) * (2 * per_group + 50)).select(rows.columns)
    order = W.partitionBy(group).orderBy(F.pmod(drawn, F.lit(place)), key)
    return few.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_group).drop("_nth")


def collect_sparse(docs: DataFrame, label: str, features: Callable[[str], Sparse]) -> list[tuple[object, Sparse]]:
    """Labels and vectors of a bounded sample (``doc_id``, ``text``, label), in order of id."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t or "") for t in b.column(2).to_pylist()]
            at = [a.astype("<i4").tobytes() for a, _ in found]
            value = [v.astype("<f4").tobytes() for _, v in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(at, pa.binary()), pa.array(value, pa.binary())],
                ["doc_id", "label", "at", "value"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["label"].dataType.simpleString()
    got = rows.mapInArrow(vectors, f"doc_id long, label {kind}, at binary, value binary").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    return [
        (label, (np.frombuffer(a, "<i4"), np.frombuffer(v, "<f4").astype(np.float64)))
        for label, a, v in zip(got["label"], got["at"], got["value"], strict=True)
    ]


def map_texts(docs: DataFrame, fn: Callable[[str | None], tuple], schema: str) -> DataFrame:
    """One row per document: ``doc_id`` and what ``fn`` makes of its whole text."""
    kinds = {"double": pa.float64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64()}
    fields = [x.split() for x in schema.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fn(t) for t in b.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * len(fields)
            arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], ["doc_id", *(f for f, _ in fields)])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(apply, f"doc_id long, {schema}")


def id_hash_mod(column: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % m
