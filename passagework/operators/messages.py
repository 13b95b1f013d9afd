"""Ingestion messages: validate JSON bodies at the edge, and build them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.arrays import let, with_once
from passagework.functions.text import strip

# Fields that must be present and not blank, in checking order.
REQUIRED = ("document_id", "s3_bucket", "s3_key", "tenant")
DEFAULT_DOC_TYPE = "10-K"

# The reasons given for a refused body.
NOT_JSON = "body is not valid JSON"
NOT_OBJECT = "body must be a JSON object"
MISSING = "required field '{}' is missing or empty"
WRONG_TYPE = "wrong type for: "


@dataclass(frozen=True)
class Checked:
    """Both sides of the edge check; each is its own lazy plan over the input."""

    valid: DataFrame
    rejected: DataFrame


_TEXT_FIELDS = (*REQUIRED, "doc_type")


def _read(body: Column) -> Column:
    """The body parsed once: is it JSON, an object, and what its fields hold.

    ``kinds`` is NULL for an absent field and VOID for JSON null, which a plain
    cast to text would not tell apart, nor 5 from "5".
    """

    def fields(document: Column, members: Column) -> Column:
        values = [F.try_element_at(members, F.lit(name)) for name in _TEXT_FIELDS]
        metadata = F.try_element_at(members, F.lit("metadata"))
        return F.struct(
            document.isNotNull().alias("is_json"),
            members.isNotNull().alias("is_object"),
            F.array(*(F.schema_of_variant(v) for v in values)).alias("kinds"),
            F.array(*(F.try_variant_get(v, "$", "string") for v in values)).alias("texts"),
            F.schema_of_variant(metadata).alias("metadata_kind"),
            F.try_variant_get(metadata, "$", "map<string,variant>").alias("metadata"),
        )

    return let(
        F.try_parse_json(body),
        lambda document: let(
            F.try_variant_get(document, "$", "map<string,variant>"),
            lambda members: fields(document, members),
        ),
    )


def _reason() -> Column:
    def kind(i: int) -> Column:
        return F.get("_read.kinds", F.lit(i))

    def missing(i: int) -> Column:
        blank = (kind(i) == "STRING") & (strip(F.get("_read.texts", F.lit(i))) == "")
        return kind(i).isNull() | (kind(i) == "VOID") | blank

    metadata_kind = F.col("_read.metadata_kind")
    foreign = F.exists(
        F.map_values("_read.metadata"), lambda v: F.schema_of_variant(v) != "STRING"
    )
    mistyped = F.concat_ws(
        ", ",
        *(F.when(kind(i) != "STRING", F.lit(name)) for i, name in enumerate(_TEXT_FIELDS)),
        F.when(~metadata_kind.startswith("OBJECT") | foreign, F.lit("metadata")),
    )
    reason = F.when(~F.col("_read.is_json"), F.lit(NOT_JSON)).when(
        ~F.col("_read.is_object"), F.lit(NOT_OBJECT)
    )
    for i, name in enumerate(REQUIRED):
        reason = reason.when(missing(i), F.lit(MISSING.format(name)))
    return reason.when(mistyped != "", F.concat(F.lit(WRONG_TYPE), mistyped))


def check_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Add ``reason`` (NULL for a good message) and the typed fields.

    The fields are NULL on refused rows; other input columns are kept. One
    narrow pass, JVM only.
    """
    others = [c for c in messages.columns if c != body]
    judged = with_once(messages, "_read", _read(F.col(body))).withColumn("reason", _reason())
    good = F.col("reason").isNull()
    # a body that names no doc_type or metadata gets the defaults
    doc_type = F.coalesce(F.get("_read.texts", F.lit(len(REQUIRED))), F.lit(DEFAULT_DOC_TYPE))
    metadata = F.coalesce(
        F.transform_values("_read.metadata", lambda _, v: F.try_variant_get(v, "$", "string")),
        F.create_map().cast("map<string,string>"),
    )
    return judged.select(
        *others,
        body,
        "reason",
        *(
            F.when(good, F.get("_read.texts", F.lit(i))).alias(name)
            for i, name in enumerate(REQUIRED)
        ),
        F.when(good, doc_type).alias("doc_type"),
        F.when(good, metadata).alias("metadata"),
    )


def split_messages(messages: DataFrame, body: str = "body") -> Checked:
    checked = check_messages(messages, body)
    others = [c for c in messages.columns if c != body]
    fields = (*REQUIRED, "doc_type", "metadata")
    return Checked(
        valid=checked.where(F.col("reason").isNull()).select(*others, *fields),
        rejected=checked.where(F.col("reason").isNotNull()).select(*others, body, "reason"),
    )


def require_valid(messages: DataFrame, body: str = "body") -> DataFrame:
    """Strict form: the job fails on the first refused message."""
    checked = check_messages(messages, body)
    others = [c for c in messages.columns if c != body]
    stop = F.raise_error(F.col("reason")).cast("string")
    document_id = F.when(F.col("reason").isNotNull(), stop).otherwise(F.col("document_id"))
    return checked.select(
        *others,
        document_id.alias("document_id"),
        *REQUIRED[1:],
        "doc_type",
        "metadata",
    )


def to_bodies(messages: DataFrame) -> DataFrame:
    """Typed messages to JSON bodies, ready for a text, Parquet or Kafka sink."""
    record = F.struct(*REQUIRED, "doc_type", "metadata")
    return messages.select(F.to_json(record).alias("body"))
