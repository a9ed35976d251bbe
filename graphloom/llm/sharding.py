"""Uniform random sharding by a two-pass external shuffle.

Pass one scatters rows over buckets small enough for memory, by a seeded hash of
the id.  Pass two loads one bucket at a time, shuffles it with Fisher-Yates and
writes it.  A uniformly random order of all rows is the buckets one after the
other; shards are equal runs of that order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import materialise, mix64, table, unused


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniformly random permutation of 0..n-1 by Fisher-Yates, drawn from ``seed``."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)  # swaps each place with a random earlier one
    return order


def _bucket_starts(counts: DataFrame, width: int = 1024) -> DataFrame:
    """``bucket, _start, _n``: rows before each bucket, summed by groups of buckets and then over the groups."""
    high = F.floor(F.col("bucket") / width).alias("_high")
    coarse = counts.groupBy(high).agg(F.sum("_n").alias("_sum"))
    before = W.orderBy("_high").rowsBetween(W.unboundedPreceding, -1)
    coarse = coarse.select("_high", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("_high").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    fine = counts.select(high, "bucket", "_n").withColumn("_inner", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return fine.join(coarse, "_high").select("bucket", (F.col("_base") + F.col("_inner")).alias("_start"), "_n")


def shard(
    docs: DataFrame,
    n_shards: int = 40,
    seed: int = 17,
    bucket_bytes: int = 16 << 20,
    min_buckets: int = 256,
) -> DataFrame:
    """Every row of ``docs`` with its ``shard`` (0 to ``n_shards`` - 1) and ``slot`` in it (gapless from 0).

    Numbers of rows in shards differ by one at most.  The order depends on
    ``seed``, the ids and the number of buckets only, so a task that runs again
    gives the same rows; equal ids are told apart by their text.

    Null ids are scattered by the hash of the text, null text counts as empty;
    an empty table gives no rows.  Columns named ``shard`` or ``slot`` are
    replaced, all others are carried along.

    Scale: one shuffle of the rows; a bucket holds about ``bucket_bytes`` of
    text.  Only the counts of buckets are summed up, in two levels.
    """
    carried = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    bucket_, place_, of_, start_, at_ = unused(carried, "_bucket", "_place", "_of", "_start", "_at")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    total, n_rows = docs.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    n_buckets = max(min_buckets, -(-total // bucket_bytes))
    key = F.coalesce(F.xxhash64(F.lit(seed), "doc_id"), F.lit(0))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(key)
    scattered = docs.select(F.pmod(key, F.lit(n_buckets)).alias(bucket_), *carried)
    counts = scattered.groupBy(F.col(bucket_).alias("bucket")).agg(F.count(F.lit(1)).alias("_n"))
    starts = materialise(_bucket_starts(counts), "shard-starts").select(F.col("bucket").alias(of_), F.col("_start").alias(start_))

    by_id, by_text = carried.index("doc_id") + 1, carried.index("text") + 1

    def shuffle_bucket(rows: pa.Table) -> pa.Table:
        bucket = rows.column(0)[0].as_py()
        ids, texts = rows.column(by_id), rows.column(by_text)
        keyed = pa.table({"i": ids, "t": texts, "at": pa.array(np.arange(rows.num_rows))})
        ordered = keyed.sort_by([("i", "ascending"), ("t", "ascending")]).column("at").to_numpy()
        mixed = ordered[fisher_yates(rows.num_rows, int(mix64(np.array([bucket + (seed << 32)], np.uint64))[0]))]
        return rows.take(pa.array(mixed)).append_column(place_, pa.array(np.arange(rows.num_rows)))

    schema = T.StructType([*scattered.schema.fields, T.StructField(place_, T.LongType())])
    shuffled = scattered.groupBy(bucket_).applyInArrow(shuffle_bucket, schema)
    q, r = divmod(n_rows, n_shards)
    at = F.col(start_) + F.col(place_)
    # The first r shards hold q + 1 rows, the others q.
    edge = r * (q + 1)
    late = F.lit(r) + F.floor((F.col(at_) - edge) / F.lit(max(q, 1)))
    number = F.when(F.col(at_) < edge, F.floor(F.col(at_) / (q + 1))).otherwise(late)
    first = F.when(F.col("shard") <= r, F.col("shard") * (q + 1)).otherwise(edge + (F.col("shard") - r) * q)
    return (
        shuffled.join(F.broadcast(starts) if n_buckets <= 10_000 else starts, F.col(bucket_) == F.col(of_))
        .withColumn(at_, at)
        .withColumn("shard", number.cast("int"))
        .select(*carried, "shard", (F.col(at_) - first).cast("long").alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows of a file in slot order."""
    (
        sharded.repartitionByRange(F.col("shard"), F.col("slot"))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by the law ``rows``: their numbers of rows differ by one at most.

    Rows that are alike in id and text are all kept; null ids and texts are rows
    like others (null text has size 16 and the checksum of nothing); an empty
    table gives no rows; other columns aren't read.
    """
    rows = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
