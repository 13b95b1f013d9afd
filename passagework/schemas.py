"""Table schemas shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE_FIELDS = ("document_id", "s3_bucket", "s3_key", "tenant", "doc_type", "metadata")

CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("chunk_id", T.StringType()),
        T.StructField("document_id", T.StringType()),
        T.StructField("tenant", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("char_offset", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

QUESTION_SCHEMA = T.StructType(
    [
        T.StructField("q_id", T.LongType()),
        T.StructField("question", T.StringType()),
        T.StructField("tenant", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("top_k", T.IntegerType()),
    ]
)
