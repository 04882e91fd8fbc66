"""A3: one row per key, the first in scan order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# More than an array can hold, so that places in one document never run into the next.
_PLACES = 10**10


def place(order: Column, position: Column) -> Column:
    """Scan order of an element inside a document as one fixed-width number, which
    keeps the minimum in a hash aggregate (a struct would force a sort)."""
    return order.cast("decimal(20,0)") * F.lit(_PLACES).cast("decimal(11,0)") + position.cast("decimal(10,0)")


def first_wins(df: DataFrame, key: Sequence[str], attributes: Sequence[str], order: str) -> DataFrame:
    """Hash aggregation over whole rows shrinks the data before any shuffle; what is
    left per key is only its differing copies, and of these the earliest wins."""
    copies = df.groupBy(*key, *attributes).agg(F.min(order).alias(order))
    first = copies.groupBy(*key).agg(F.min_by(F.struct(*attributes), order).alias("_first"))
    return first.select(*key, "_first.*")
