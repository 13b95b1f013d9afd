"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor kept, as a stored table, and all but the last return
the columns of ``documents``. Rows are told apart by ``doc_id`` and text; null texts count
as empty. A stage's result must be stored before the next stage is called, which removes
the intermediate tables of the one before.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import decontaminate, near_duplicates, packing, pii, rules
from passagework.llm.common import unused
from passagework.session import delete_path, scratch_mark, take_scratch, written

_LEFT: list[str] = []


def _stage(function):
    """Removes what the stage before has left; what this one leaves is kept for the next."""

    @wraps(function)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _LEFT:
            delete_path(spark, path)
        mark = scratch_mark()
        try:
            return function(spark, docs, sf_dir)
        finally:
            _LEFT[:] = take_scratch(mark)

    return staged


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but for those named by (doc_id, text_key).

    Texts move once, to the names, at every size: what is named grows with the input.
    """
    d, k, own = unused(docs, "_d", "_k", "_key")
    named = written(dropped.select(F.col("doc_id").alias(d), F.col("text_key").alias(k)).distinct(), "dropped").hint("shuffle_hash")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    kept = docs.withColumn(own, key).join(
        named, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(own) == F.col(k)), "left_anti"
    )
    return kept.select(*docs.columns)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return _without(docs, rules.quality_rules(docs).where("NOT kept"))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return near_duplicates.without_duplicates(docs)


@_stage
def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a test item stands."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.decontaminate(docs, benchmark).where("contaminated"))


@_stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; no document goes."""
    return pii.redact(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a training sequence."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", clean_of_benchmark),
    ("pii", redact),
    ("best_fit_packing", pack),
]

#: Estimates, classifiers and packing are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
