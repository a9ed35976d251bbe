"""Pieces shared by the corpus operators: shared-folder tables, word splitting, hashing."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ship import ship

#: ASCII white space; the only characters that separate words or are folded.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


# --------------------------------------------------------------------------- tables
def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor and the driver can reach.

    The cluster names it in ``spark.checkpoint.dir`` or by ``setCheckpointDir``.
    Where neither is set, a session that runs within the driver (local tests) gets
    a fresh temporary folder; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master) is None:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="graphloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: whatever is derived from the result survives lost
    executors and sees the same rows on every read.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/graphloom/{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession) -> None:
    """Delete what :func:`materialise` has written in this application; results that read it must have been used by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores behind where a column is called so already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A side of a join is broadcast up to so many bytes, as counted by :func:`bytes_of`.
BROADCAST_BYTES = 1 << 20


def _bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType)):
            return F.coalesce(F.aggregate(value, F.lit(16).cast("long"), lambda s, x: s + _bytes(x, kind.elementType).cast("long")), F.lit(16))
        return F.greatest(F.size(value), F.lit(0)) * _fixed(kind.elementType) + 16
    return F.lit(_fixed(kind))


def _fixed(kind: T.DataType) -> int:
    return sum(_fixed(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else 8


def bytes_of(df: DataFrame) -> int:
    """About the bytes of all rows of ``df`` in memory; arrays and texts count with what they hold."""
    row = sum((_bytes(F.col(f.name), f.dataType) for f in df.schema), F.lit(16))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def broadcast_if(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df``, which is cheap to read, marked for broadcast if it has no more than ``limit`` bytes; else for a sorted merge."""
    return F.broadcast(df) if bytes_of(df) <= (BROADCAST_BYTES if limit is None else limit) else df.hint("merge")


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` is in ``gone``; rows of null id stay."""
    gone = materialise(gone.select("doc_id").where("doc_id IS NOT NULL"), "gone")
    return docs.join(broadcast_if(gone), "doc_id", "left_anti").select(docs.columns)


def fold_space(text: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space (not trimmed)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), ASCII_SPACE, " ")


def group_ranks(
    df: DataFrame,
    group: str,
    fine: str,
    order: list[str],
    out: str = "_rank",
    coarse: int = 512,
) -> DataFrame:
    """Gapless rank (from 0) of each row in its ``group``, without sorting a whole group in one task.

    ``fine`` is an integer column without nulls that splits every group into
    pieces of bounded size (a hash bucket): rows are ordered by ``(fine, *order)``.
    Only counts of pieces are summed over a group, in two levels, so a group
    holding a third of all rows is numbered by as many tasks as it has pieces.
    """
    high = F.floor(F.col(fine) / coarse).alias("_high")
    counts = df.groupBy(group, fine).agg(F.count(F.lit(1)).alias("_n")).select("*", high)
    counts = materialise(counts, "counts")
    over_high = W.partitionBy(group).orderBy("_high").rowsBetween(W.unboundedPreceding, -1)
    over_fine = W.partitionBy(group, "_high").orderBy(fine).rowsBetween(W.unboundedPreceding, -1)
    bases = counts.groupBy(group, "_high").agg(F.sum("_n").alias("_sum"))
    bases = bases.select(group, "_high", F.coalesce(F.sum("_sum").over(over_high), F.lit(0)).alias("_base"))
    inner = counts.withColumn("_inner", F.coalesce(F.sum("_n").over(over_fine), F.lit(0)))
    starts = inner.join(bases, [group, "_high"]).select(group, fine, (F.col("_base") + F.col("_inner")).alias("_start"))
    starts = broadcast_if(materialise(starts, "starts"))
    within = F.row_number().over(W.partitionBy(group, fine).orderBy(*order)) - 1
    ranked = df.withColumn("_within", within).join(starts, [group, fine])
    return ranked.select(*df.columns, (F.col("_within") + F.col("_start")).cast("long").alias(out))


# --------------------------------------------------------------------------- hashing
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, np.uint64(b))
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(0xD1342543DE82EF95)
_BYTE_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every maximal run of bytes that are not ASCII white space."""
    solid = np.empty(len(raw) + 2, np.int8)
    solid[0] = solid[-1] = 0
    solid[1:-1] = ~_IS_SPACE[raw]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: bytes, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word of UTF-8 ``data``; ``lower`` folds A-Z first."""
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = _LOWER[raw]
    start, end = word_bounds(raw)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _BYTE_POWERS.need(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_TABLE[raw] * up[: len(raw)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _GOLD)


def window_hashes(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _WORD_POWERS.need(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    x = mix64(words + np.uint64(salt) * _GOLD) if salt else words
    np.cumsum(x * up[: len(words)], out=total[1:])
    return mix64((total[size:] - total[:n]) * down[:n] + np.uint64((size + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
