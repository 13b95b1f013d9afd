"""Keyed upsert as DataFrame operations.

Within a batch the record with the highest ``seq`` gives the plain columns, maps
are merged key by key over all records. Against the stored rows the incoming
columns win even when NULL, columns the batch does not carry survive, and maps
are merged once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _merged_map(batch: DataFrame, key: str, seq: str, column: str) -> DataFrame:
    """The last value of every map key, per record key.

    The maximum combines before the shuffle, so a key repeated in a third of the
    batch costs one row per task and map key.
    """
    entries = batch.select(key, seq, F.explode(column).alias("_k", "_v"))
    last = entries.groupBy(key, "_k").agg(F.max_by("_v", seq).alias("_v"))
    return last.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias(column)
    )


def fold_batch(
    batch: DataFrame,
    key: str = "chunk_id",
    seq: str = "seq",
    map_columns: Sequence[str] = ("metadata",),
) -> DataFrame:
    """One record per key, in the order of ``seq`` (unique within a key); drops ``seq``."""
    maps = [c for c in map_columns if c in batch.columns]
    newest = Window.partitionBy(key).orderBy(F.col(seq).desc())
    latest = (
        batch.drop(*maps)
        .withColumn("_newest", F.row_number().over(newest))
        .where(F.col("_newest") == 1)
        .drop("_newest", seq)
    )
    for column in maps:
        map_type = batch.schema[column].dataType
        latest = latest.join(_merged_map(batch, key, seq, column), key, "left").withColumn(
            column, F.coalesce(F.col(column), F.create_map().cast(map_type))
        )
    return latest.select(*(c for c in batch.columns if c != seq))


def fold_single(batch: DataFrame, seq: str = "seq", map_columns: Sequence[str] = ("metadata",)) -> DataFrame:
    """What ``fold_batch`` makes of records whose keys come once; narrow."""
    filled = {
        c: F.coalesce(F.col(c), F.create_map().cast(batch.schema[c].dataType)) for c in map_columns if c in batch.columns
    }
    return batch.withColumns(filled).drop(seq)


def _merge_maps(old: Column, new: Column) -> Column:
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.when(old.isNull(), new).otherwise(F.map_concat(kept, new))


def merge_records(
    stored: DataFrame,
    folded: DataFrame,
    key: str = "chunk_id",
    map_columns: Sequence[str] = ("metadata",),
) -> DataFrame:
    """Stored rows after the upsert of ``folded`` (one row per key)."""
    old = stored.alias("old")
    new = folded.withColumn("_arrived", F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    arrived = F.coalesce(F.col("new._arrived"), F.lit(False))

    def merged(column: str) -> Column:
        if column not in folded.columns:
            return F.col(f"old.{column}")
        new_value = F.col(f"new.{column}")
        if column not in stored.columns:
            return new_value
        old_value = F.col(f"old.{column}")
        if column in map_columns:
            new_value = _merge_maps(old_value, new_value)
        return F.when(arrived, new_value).otherwise(old_value).alias(column)

    added = [c for c in folded.columns if c not in stored.columns]
    return joined.select(*(merged(c).alias(c) for c in (*stored.columns, *added)))


def upsert_records(
    stored: DataFrame,
    batch: DataFrame,
    key: str = "chunk_id",
    seq: str = "seq",
    map_columns: Sequence[str] = ("metadata",),
) -> DataFrame:
    return merge_records(stored, fold_batch(batch, key, seq, map_columns), key, map_columns)
