"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def build_session(master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings the library relies on."""
    builder = (
        SparkSession.builder.appName("passagework")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # call-site capture costs more than building the expressions themselves
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Set the runtime options that change results.

    JSON objects may repeat a key and the last one counts, as in most JSON
    readers; VARIANT refuses such objects unless told otherwise.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only when the session names none and runs on one machine (``local`` master), a
    temporary one is made and set as the checkpoint folder; a cluster must name one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="passagework-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; Spark creates it on first write."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """Compute once: write to the shared folder and read back what was written.

    Cuts the lineage in a place that outlives any executor, and later readers
    prune columns. The files stay until ``remove_scratch``; see ``staged`` for ones
    that go by themselves.
    """
    path = scratch_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """Like ``written`` for the time of a block; its own files are removed after it."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of this library through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def scratch_mark() -> int:
    """A place in the list of what ``written`` has left, for ``take_scratch``."""
    return len(_WRITTEN)


def take_scratch(mark: int) -> list[str]:
    """The folders that ``written`` has left since ``mark``; removing them is the caller's task now."""
    taken, _WRITTEN[mark:] = _WRITTEN[mark:], []
    return taken


def remove_scratch(spark: SparkSession) -> int:
    """Remove all that ``written`` has left so far; returns the number of folders.

    Frames that read those files can't be used any more: call it between jobs.
    """
    paths, _WRITTEN[:] = list(_WRITTEN), []
    for path in paths:
        delete_path(spark, path)
    return len(paths)
