"""Search by cells: vectors are grouped into cells, a question visits those it has to.

``nearest_in_cells`` visits a fixed number: recall grows with ``nprobe`` and with overlapping
cells; every cell gives the exact result. ``nearest_by_bound`` needs no number: a cell is
left out when its bound (centre and radius) shows that it holds no better hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.functions.vectors import l2_normalise
from passagework.operators.search import DEFAULT_TOP_K, PAYLOAD, nearest

CENTROID_BYTES = 256 << 20


def fit_centroids(
    chunks: DataFrame,
    n_cells: int,
    *,
    seed: int = 7,
    max_iter: int = 10,
) -> list[list[float]]:
    """``n_cells`` cell centres by distributed k-means over all unit vectors."""
    unit = chunks.select(l2_normalise(F.col("embedding")).alias("unit")).where(
        F.col("unit").isNotNull()
    )
    training = unit.select(array_to_vector("unit").alias("features")).persist()
    try:
        model = KMeans(k=n_cells, seed=seed, maxIter=max_iter).fit(training)
    finally:
        training.unpersist()
    return [list(map(float, centre)) for centre in model.clusterCenters()]


def label_centroids(chunks: DataFrame, label: str) -> list[list[float]]:
    """The mean unit vector of each label, in the order of labels, as cell centres.

    For vectors that come with a coarse grouping. Sums are combined per position before
    the shuffle; rows without a vector or label have no part.
    """
    unit = chunks.select(F.col(label).alias("label"), l2_normalise(F.col("embedding")).alias("unit"))
    places = unit.where("unit IS NOT NULL AND label IS NOT NULL").select(
        "label", F.posexplode("unit").alias("at", "x")
    )
    means = places.groupBy("label", "at").agg(F.avg("x").alias("x"))
    rows = (
        means.groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("at", "x")))["x"].alias("centre"))
        .orderBy("label")
        .collect()  # one row per label: they become the cells that a task holds
    )
    return [list(r["centre"]) for r in rows]


def _least(distance: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` least of each row, least first, ties to the left."""
    if n < distance.shape[1]:
        edge = np.partition(distance, n - 1, axis=1)[:, n - 1 : n]
        # all below the edge, and of those at it the leftmost that fit
        below = distance < edge
        room = n - below.sum(axis=1, keepdims=True)
        level = distance == edge
        chosen = below | level & (np.cumsum(level, axis=1) <= room)
        at = np.nonzero(chosen)[1].reshape(len(distance), n)
    else:
        at = np.broadcast_to(np.arange(distance.shape[1]), distance.shape)
    order = np.argsort(np.take_along_axis(distance, at, axis=1), axis=1, kind="stable")
    return np.take_along_axis(at, order, axis=1)


def nearest_cells(vector: Column, centroids: list[list[float]], n: int) -> Column:
    """The ``n`` nearest cells of each vector, nearest first; NULL without a vector."""
    centres = np.asarray(centroids, dtype=np.float64)
    if centres.nbytes > CENTROID_BYTES:
        raise ValueError("the centroids do not fit the broadcast bound")
    squares = (centres * centres).sum(axis=1)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list = [None] * len(batch)
            present = [i for i, v in enumerate(batch) if v is not None]
            if present:
                rows = np.stack([batch.iat[i] for i in present]).astype(np.float64)
                length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                rows = np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)
                distance = np.round(squares[None, :] - 2.0 * (rows @ centres.T), 12)
                order = _least(distance, n).astype(np.int32)
                for i, found in zip(present, order, strict=True):
                    out[i] = found
            yield pd.Series(out, dtype=object)

    return cells(vector)


def assign_cells(chunks: DataFrame, centroids: list[list[float]], copies: int = 1, spill: float = 1.0) -> DataFrame:
    """Add ``cell``; store it with the chunks so that it is computed once.

    With two ``copies`` each vector also stands in a second cell: the nearest after a
    penalty, ``spill`` times the squared part of the second residual that points along the
    first. Where the first cell misjudges a vector for a question, such a second one doesn't.
    """
    if copies == 1:
        found = nearest_cells(F.col("embedding"), centroids, 1)
        return chunks.withColumn("cell", F.element_at(found, 1))
    found = residual_cells(F.col("embedding"), centroids, spill)
    return chunks.withColumn("cell", F.explode_outer(F.array_distinct(found)))


def residual_cells(vector: Column, centroids: list[list[float]], spill: float) -> Column:
    """[nearest cell, second cell by residual angle] of each vector; NULL without a vector."""
    centres = np.asarray(centroids, dtype=np.float64)
    squares = (centres * centres).sum(axis=1)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def cells(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list = [None] * len(batch)
            present = [i for i, v in enumerate(batch) if v is not None]
            if present:
                rows = np.stack([batch.iat[i] for i in present]).astype(np.float64)
                length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
                rows = np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)
                dots = rows @ centres.T
                distance = np.round(squares[None, :] - 2.0 * dots, 12)
                first = distance.argmin(axis=1)
                residual = rows - centres[first]
                along = (rows * residual).sum(axis=1, keepdims=True) - residual @ centres.T
                norm = (residual * residual).sum(axis=1, keepdims=True)
                cost = distance + spill * np.divide(along * along, norm, out=np.zeros_like(along), where=norm > 0)
                cost[np.arange(len(first)), first] = np.inf
                second = np.where(np.isfinite(cost).any(axis=1), np.round(cost, 12).argmin(axis=1), first)
                for i, a, b in zip(present, first.tolist(), second.tolist(), strict=True):
                    out[i] = [a, b]
            yield pd.Series(out, dtype=object)

    return cells(vector)


def nearest_in_cells(
    questions: DataFrame,
    celled_chunks: DataFrame,
    centroids: list[list[float]],
    *,
    dim: int,
    nprobe: int,
    payload: tuple[str, ...] = PAYLOAD,
    default_k: int = DEFAULT_TOP_K,
    **limits: int,
) -> DataFrame:
    """Like ``nearest`` over the chunks of the ``nprobe`` cells nearest to each question."""
    visits = questions.withColumn(
        "cell", F.explode(nearest_cells(F.col("vector"), centroids, nprobe))
    )
    return nearest(
        visits,
        celled_chunks,
        dim=dim,
        extra_keys=("cell",),
        payload=payload,
        default_k=default_k,
        **limits,
    )


def nearest_by_bound(
    questions: DataFrame,
    celled_chunks: DataFrame,
    *,
    dim: int,
    payload: tuple[str, ...] = PAYLOAD,
    default_k: int = DEFAULT_TOP_K,
    **limits: int,
) -> DataFrame:
    """Like ``nearest``, with its result; chunks stand in one cell each, best stored in its order.

    A task looks at a cell for a question only while the bound over the cell's rows reaches
    the k-th score found so far.
    """
    return nearest(
        questions, celled_chunks, dim=dim, near="cell", payload=payload, default_k=default_k, **limits
    )
