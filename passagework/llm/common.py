"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_SPACE = " \t\n\x0b\x0c\r"
NO_SPACE_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CACHE = "passagework_worker_cache"


def worker_cache(key: str, make: Callable):
    """One object per Python worker: functions travel by value, so module globals don't last."""
    store = sys.modules.setdefault(_CACHE, types.ModuleType(_CACHE)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, _UPPER, _LOWER)


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and ``text`` (null: empty); other columns can't get in the way."""
    return docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def doc_key(docs: DataFrame) -> DataFrame:
    """Add ``text_key``: with ``doc_id`` it tells rows apart unless they are equal in both."""
    return docs.withColumn("text_key", F.xxhash64("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before each as it takes to be no column of ``df``."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name = f"_{name}"
        held.add(name.lower())
        out.append(name)
    return out


def partitions(df: DataFrame) -> int:
    """The cluster's number of shuffle partitions, for salts and block counts."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small_batches(frames: Iterator[pd.DataFrame], column: str, chars: int) -> Iterator[pd.DataFrame]:
    """Cut batches so that each holds about ``chars`` characters, one row at least."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = frame[column].str.len().to_numpy()
        cut = (sizes.cumsum() - sizes) // chars
        for _, part in frame.groupby(cut, sort=True):
            yield part


def shared_fs(path: str):
    """(file system, path in it) of a path in the shared folder, for tasks that write files of their own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)
