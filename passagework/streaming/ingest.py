"""Event-driven ingestion: a stream of message bodies into the chunk table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from passagework.operators.embed import EmbeddingProvider
from passagework.operators.messages import check_messages
from passagework.plans.ingestion import (
    IngestSettings,
    balanced,
    documents_to_embedded_chunks,
)
from passagework.session import staged
from passagework.sources.chunk_table import ChunkTable
from passagework.sources.queue import read_queue

NOT_FOUND = "document not found"


def message_files(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """One body per line of the text files that arrive in ``path``.

    ``max_files_per_trigger`` is the back-pressure: a batch never takes more.
    """
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .select(
            F.col("value").alias("body"),
            F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("_order"),
        )
    )


def message_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int
) -> DataFrame:
    """One body per record of a Kafka topic (needs Spark's Kafka package on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
        .select(
            F.col("value").cast("string").alias("body"),
            F.struct("timestamp", "partition", "offset").alias("_order"),
        )
    )


def message_queue(spark: SparkSession, root: str, max_bytes_per_trigger: int, group: str = "default") -> DataFrame:
    """One body per message of a queue (``sources.queue``).

    Messages with one key are in order if their producers put them in one log. A bounded
    batch is taken at a time: run it with ``continuous`` and end it with ``drain``.
    """
    found = read_queue(spark, root, max_bytes_per_trigger, group)
    return found.select("body", F.struct("position", "log").alias("_order"))


def drain(query: StreamingQuery) -> None:
    """Wait until all that has arrived is done, in as many batches as it takes, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def ingest_batch(
    bodies: DataFrame,
    attach: Callable[[DataFrame], DataFrame],
    table: ChunkTable,
    settings: IngestSettings,
    load: Callable[[], EmbeddingProvider],
    rejects: str,
) -> int:
    """Validate, read, parse, chunk, embed and upsert one batch.

    ``bodies(body, seq)``; ``attach`` adds ``content`` to valid messages.
    Refused messages and missing documents are written to ``rejects`` with their
    reason, replacing what an earlier try of the same batch left there.
    """
    checked = check_messages(bodies)
    valid = checked.where(F.col("reason").isNull()).drop("reason")
    # few files of short messages name many documents: messages are spread before those are opened.
    # The documents are opened once, then read for the chunks and for the rejects
    with staged(attach(balanced(valid, "seq"))) as loaded:
        refused = checked.where(F.col("reason").isNotNull()).select("body", "reason")
        absent = loaded.where(F.col("content").isNull()).select(
            "body", F.lit(NOT_FOUND).alias("reason")
        )
        refused.unionByName(absent).write.mode("overwrite").parquet(rejects)
        documents = balanced(
            loaded.where(F.col("content").isNotNull()).select(
                "document_id", "tenant", "doc_type", "metadata", "seq", "content"
            ),
            "seq",
        )
        # a chunk's key ends in its two numbers, so only a document that came twice repeats keys
        twice = loaded.groupBy("document_id").count().where("count > 1")
        return table.upsert(documents_to_embedded_chunks(documents, settings, load), distinct=twice.isEmpty())


def start_ingest(
    bodies: DataFrame,
    attach: Callable[[DataFrame], DataFrame],
    table: ChunkTable,
    settings: IngestSettings,
    load: Callable[[], EmbeddingProvider],
    *,
    checkpoint: str,
    rejects: str,
    continuous: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Run ``ingest_batch`` per micro-batch, over all that has arrived or for ever.

    ``bodies`` comes from ``message_files``, ``message_topic`` or ``message_queue``.

    No state store is needed: the upsert is keyed, so a batch that is replayed
    after a failure leads to the same rows.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        order = F.struct("_order", F.monotonically_increasing_id().alias("_row"))
        ordered = batch.select("body", order.alias("seq"))
        ingest_batch(
            ordered, attach, table, settings, load, f"{rejects}/batch_id={batch_id}"
        )

    writer = bodies.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if continuous:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
