"""The write path as one lazy plan: messages and bytes to embedded chunks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from passagework.operators.chunk import chunk_pages
from passagework.operators.embed import EmbeddingProvider, embed_chunks
from passagework.operators.parse import SECTION_TARGET_TOKENS, parse_documents


@dataclass(frozen=True)
class IngestSettings:
    size_tokens: int
    overlap_percentage: float
    target_tokens: int = SECTION_TARGET_TOKENS
    tokenizer: object | None = None


def balanced(df: DataFrame, key: str) -> DataFrame:
    """Spread a few large input files over the cluster before per-row work.

    ``key`` is unique, so no task gets more than its share. An input with at
    least as many partitions as the cluster has cores is left as it is, so a
    large scan is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents_to_chunks(documents: DataFrame, settings: IngestSettings) -> DataFrame:
    """``documents(document_id, tenant, doc_type, ..., content)`` to chunks; no shuffle."""
    pages = parse_documents(
        documents, "content", settings.target_tokens, settings.tokenizer
    )
    return chunk_pages(
        pages, settings.size_tokens, settings.overlap_percentage, settings.tokenizer
    )


def documents_to_embedded_chunks(
    documents: DataFrame, settings: IngestSettings, load: Callable[[], EmbeddingProvider]
) -> DataFrame:
    return embed_chunks(documents_to_chunks(documents, settings), load)
