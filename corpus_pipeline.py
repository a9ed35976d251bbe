"""The corpus pipeline: from raw documents to packed training sequences.

Part of the ``llm`` subpackage.  Each stage takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written and read again as the next one's ``docs``;
all stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm import exact_dedup, minhash_dedup, mixing, packing, quality
from graphloom.llm.common import materialise, table, without_ids


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, taught by ``labels``, doesn't reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each text."""
    groups = exact_dedup.exact_dedup(docs, exact_dedup.history_half(docs))
    return without_ids(docs, groups.where("NOT kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates: five-word shingles, similarity 0.8."""
    classes = minhash_dedup.near_duplicates(docs, size=5, percent=80)
    return without_ids(docs, classes.where("NOT kept"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which sources are interleaved."""
    return mixing.in_order(mixing.mix(docs, mixing.tempered()), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 ids, with the ids; ``sequence_order`` carries on the order in which sources are mixed."""
    return packing.pack(docs, packing.default_tokenizer(), order=mixing.written_order(docs))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier, the mixing order or the packing: stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
