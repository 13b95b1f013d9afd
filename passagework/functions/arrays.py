"""Array helpers whose cost stays linear in the array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GROUP = 1024


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A lambda variable is never inlined by the optimizer, so an expensive array
    used inside a nested lambda is computed once per row, not once per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever is filtered later.

    A filter on a projected column is pushed below the projection with a copy of
    its expression for every mention; it is not pushed below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _running(values: Column) -> Column:
    """struct(total, out): the sum, and for each element the sum of those before it."""
    return F.aggregate(
        values,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out")),
        lambda acc, v: F.struct(
            (acc["total"] + v).alias("total"),
            F.array_append(acc["out"], acc["total"]).alias("out"),
        ),
    )


def exclusive_prefix_sums(values: Column) -> Column:
    """[v0, v1, v2] -> [0, v0, v0+v1].

    Appending copies the array, so the fold runs over groups of a fixed size and
    the group totals are summed in a second, much shorter fold.
    """
    groups = F.transform(
        F.sequence(F.lit(0), F.size(values) - 1, F.lit(_GROUP)),
        lambda start: _running(F.slice(values, start + 1, _GROUP)),
    )
    summed = let(
        groups,
        lambda gs: F.flatten(
            F.zip_with(
                F.transform(gs, lambda g: g["out"]),
                _running(F.transform(gs, lambda g: g["total"]))["out"],
                lambda out, base: F.transform(out, lambda x: x + base),
            )
        ),
    )
    return F.when(F.size(values) > 0, summed).otherwise(F.array().cast("array<int>"))
