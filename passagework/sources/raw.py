"""Raw document bytes for ingestion messages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FETCH_BYTES = 32 << 20


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` as ``(object, content)``; for loading a whole store.

    ``object`` is the path below ``root``, that is bucket/key.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    )
    # the scheme and its slashes vary between file systems, the root's own path does not
    below = root.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    at = F.instr(F.col("path"), F.lit(below))
    return files.select(
        F.substr(F.col("path"), at + len(below)).alias("object"), "content"
    )


def attach_files(messages: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``content`` from scanned files; NULL where the object is missing."""
    wanted = messages.withColumn("object", F.concat_ws("/", "s3_bucket", "s3_key"))
    return wanted.join(files, "object", "left").drop("object")


def store_files(objects: DataFrame, root: str) -> int:
    """Write ``content`` of each row as ``root/s3_bucket/s3_key``; the number of files written.

    A file that is written again, by a retried task too, holds the same bytes. Rows without
    content are skipped. Runs a job; ``root`` is as in ``fetch_files``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(root)
        made = set()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("s3_bucket", "s3_key", "content"))
            done = 0
            for bucket, key, content in zip(*columns, strict=True):
                if content is None:
                    continue
                path = f"{base.rstrip('/')}/{bucket}/{key}"
                below = path.rsplit("/", 1)[0]
                if below not in made:
                    store.create_dir(below, recursive=True)
                    made.add(below)
                with store.open_output_stream(path, compression=None) as stream:
                    stream.write(content)
                done += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([done], pa.int64())})

    rows = objects.select("s3_bucket", "s3_key", "content").mapInArrow(write, "n long")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _file_system(root: str):
    """(file system, path) of a path or a URI that Arrow's file systems know."""
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def fetch_files(messages: DataFrame, root: str) -> DataFrame:
    """Add ``content`` by opening ``root/bucket/key`` for each message.

    Reads exactly the named objects, spread over the tasks of ``messages``; no
    listing. ``content`` is NULL where the object is missing. ``root`` is a path
    or a URI that Arrow's file systems know.
    """
    schema = T.StructType([*messages.schema.fields, T.StructField("content", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _file_system(root)

        def load(bucket: str, key: str) -> bytes | None:
            try:
                with store.open_input_stream(f"{base.rstrip('/')}/{bucket}/{key}", compression=None) as stream:
                    return stream.read()
            except FileNotFoundError:
                return None

        for batch in batches:
            buckets = batch.column("s3_bucket").to_pylist()
            keys = batch.column("s3_key").to_pylist()
            start, held, contents = 0, 0, []
            for i, (bucket, key) in enumerate(zip(buckets, keys, strict=True)):
                contents.append(load(bucket, key))
                held += len(contents[-1] or b"")
                if held >= _FETCH_BYTES or i == len(keys) - 1:
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(contents, type=pa.binary())],
                        names=[*part.schema.names, "content"],
                    )
                    start, held, contents = i + 1, 0, []

    return messages.mapInArrow(read, schema)
