"""Vector columns: norms, unit length, width checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.arrays import let


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            vector,
            F.lit(0.0),
            lambda total, x: total + x.cast("double") * x.cast("double"),
        )
    )


def l2_normalise(vector: Column) -> Column:
    """The vector at unit length, in double; NULL for a zero vector."""
    return let(
        norm(vector),
        lambda length: F.when(
            length > 0, F.transform(vector, lambda x: x.cast("double") / length)
        ),
    )


def has_width(vector: Column, dim: int) -> Column:
    return F.coalesce(F.size(vector) == F.lit(dim), F.lit(False))


def require_searchable(vector: Column, dim: int, chunk_id: Column) -> Column:
    """The vector itself; the job fails on a missing one or one of another width."""
    return (
        F.when(
            vector.isNull(),
            F.raise_error(F.concat(F.lit("chunk "), chunk_id, F.lit(" has no embedding"))),
        )
        .when(
            F.size(vector) != F.lit(dim),
            F.raise_error(
                F.concat(
                    F.lit("chunk "),
                    chunk_id,
                    F.lit(" has an embedding of width "),
                    F.size(vector).cast("string"),
                    F.lit(f", the table holds {dim}"),
                )
            ),
        )
        .otherwise(vector)
    )


def unsearchable(chunks: DataFrame, dim: int) -> DataFrame:
    """Rows a table of width ``dim`` would refuse: ``(chunk_id, reason)``."""
    reason = F.when(F.col("embedding").isNull(), F.lit("has no embedding")).when(
        F.size("embedding") != dim, F.lit("has an embedding of another width")
    )
    return chunks.select("chunk_id", reason.alias("reason")).where(F.col("reason").isNotNull())
