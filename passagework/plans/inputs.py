"""How the given tables play the roles of filings, questions, messages and feeds.

The SQL texts hold for Spark and DuckDB alike; the oracles start from the same ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.plans.ingestion import balanced
from passagework.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Text with symbol runs, for the lint.
RUN_TEXT = (
    "text || ' Item ' || CAST(doc_id AS STRING) || repeat('.', CAST(doc_id % 9 AS INT)) "
    "|| CAST(n_chars AS STRING) || repeat('-', CAST(n_chars % 7 AS INT)) || ' ====== ' "
    "|| repeat('_', CAST(doc_id % 8 AS INT)) || 'eeeeee' || repeat('*', 3)"
)

# Text with tabs, other line ends, blank lines and no-break spaces.
SPACED_TEXT = (
    "replace(replace(text, ', ', ',' || chr(9) || ' ' || chr(9)), '. ', '.' || chr(13) || chr(10)) "
    "|| chr(12) || '  ' || chr(160) || ' tail' || chr(160) || 'end ' || chr(160) || chr(11) || '   ' "
    "|| chr(13) || CAST(doc_id AS STRING)"
)

_EVENT_HEAD = (
    """'{"document_id":"E-' || CAST(event_id AS STRING) || '","s3_bucket":"raw","s3_key":"k/' """
    """|| CAST(event_id AS STRING) || '"'"""
)
_EVENT_TENANT = """',"tenant":"u' || CAST(user_id AS STRING) || '"'"""

# Message bodies, good and faulty, one per event.
EVENT_BODY = f"""CASE event_id % 14
  WHEN 1 THEN {_EVENT_HEAD} || {_EVENT_TENANT} || '}}'
  WHEN 2 THEN '{{"document_id":"   ","s3_bucket":"raw","s3_key":"k"' || {_EVENT_TENANT} || '}}'
  WHEN 3 THEN {_EVENT_HEAD} || '}}'
  WHEN 4 THEN '{{"document_id":"E","s3_bucket":"raw","s3_key":5' || {_EVENT_TENANT} || ',"doc_type":false}}'
  WHEN 5 THEN 'not-json{{' || event_type
  WHEN 6 THEN '[1, "' || event_type || '"]'
  WHEN 7 THEN {_EVENT_HEAD} || {_EVENT_TENANT} || ',"metadata":{{"type":"' || event_type || '","k":7}}}}'
  WHEN 8 THEN {_EVENT_HEAD} || {_EVENT_TENANT} || ',"doc_type":null}}'
  WHEN 9 THEN {_EVENT_HEAD} || ',"tenant":null}}'
  WHEN 10 THEN {_EVENT_HEAD} || {_EVENT_TENANT} || ',"doc_type":"","extra":[1,2]}}'
  WHEN 11 THEN 'null'
  WHEN 12 THEN {_EVENT_HEAD} || {_EVENT_TENANT} || ',"metadata":' || props || '}}'
  WHEN 13 THEN '{{"document_id":"E","s3_bucket":"' || chr(160) || '","s3_key":"k"' || {_EVENT_TENANT} || '}}'
  ELSE {_EVENT_HEAD} || {_EVENT_TENANT} || ',"doc_type":"' || event_type || '","metadata":{{"type":"' || event_type || '"}}}}'
END"""

# A question per labelled document: its vector, asked within its own source.
QUESTION_TOP_K = "CASE WHEN quality = 1 THEN 3 WHEN toxic = 1 THEN 0 ELSE NULL END"
QUESTION_DOC_TYPE = "CASE WHEN quality = 1 THEN lang WHEN toxic = 1 THEN '' ELSE NULL END"


class Tables:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        configure(spark)
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def filings(self) -> DataFrame:
        """Documents as plain-text filings; tenant is the source, type the language."""
        return balanced(self.documents, "doc_id").select(
            F.col("doc_id").cast("string").alias("document_id"),
            F.col("source").alias("tenant"),
            F.col("lang").alias("doc_type"),
            F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
            F.col("text").alias("content"),
        )

    def web_filings(self) -> DataFrame:
        return balanced(self.pages, "page_id").select(
            F.col("page_id").cast("string").alias("document_id"),
            F.col("html").alias("content"),
        )

    def vector_chunks(self) -> DataFrame:
        """One chunk per embedded document."""
        documents = self.documents.withColumnRenamed("doc_id", "vec_id")
        return self.embeddings.join(documents, "vec_id").select(
            F.concat_ws(":", F.col("vec_id"), F.lit(1), F.lit(0)).alias("chunk_id"),
            F.col("vec_id").cast("string").alias("document_id"),
            F.col("source").alias("tenant"),
            F.col("lang").alias("doc_type"),
            F.lit(1).alias("page_number"),
            "text",
            "embedding",
            "label",
        )

    def vector_questions(self) -> DataFrame:
        """``doc_type`` is left open here; see ``QUESTION_DOC_TYPE``."""
        labelled = self.labels.join(self.documents, "doc_id")
        return labelled.join(self.embeddings, labelled["doc_id"] == F.col("vec_id")).select(
            F.col("doc_id").alias("q_id"),
            F.col("source").alias("tenant"),
            F.lit(None).cast("string").alias("doc_type"),
            F.expr(QUESTION_DOC_TYPE).alias("scoped_type"),
            F.expr(QUESTION_TOP_K).alias("top_k"),
            F.col("embedding").alias("vector"),
        )

    def text_questions(self) -> DataFrame:
        """User turns as questions, spread over the tenants."""
        return self.conversations.where(F.col("role") == "user").select(
            F.concat_ws("-", "conv_id", "turn").alias("q_id"),
            F.col("text").alias("question"),
            F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("tenant"),
            F.lit(None).cast("string").alias("doc_type"),
            F.lit(None).cast("int").alias("top_k"),
        )

    def bodies(self) -> DataFrame:
        return balanced(self.events, "event_id").select("event_id", F.expr(EVENT_BODY).alias("body"))
