"""Numbering of array elements (W1-W7) and text rebuilt from positions.

All of these work inside one record, so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def present(array: Column) -> Column:
    """the elements that are neither null nor empty."""
    return F.filter(array, lambda x: x.isNotNull() & (x != ""))


def not_null(array: Column) -> Column:
    return F.filter(array, lambda x: x.isNotNull())


def each(array: Column, use: Callable[[Column], Column]) -> Column:
    return F.transform(array, use)


def numbered(df: DataFrame, keep: Sequence, array: Column, seq: str, item: str = "item") -> DataFrame:
    """One row per element, numbered from 1 (W1; W2 and W3 once the array is cleaned)."""
    rows = df.select(*keep, F.posexplode(array).alias("_pos", item))
    return rows.withColumn(seq, F.col("_pos") + 1).drop("_pos")


def where_present(df: DataFrame, keep: Sequence, value: Column, name: str) -> DataFrame:
    """Rows whose ``value`` is not null; a generator, so that a costly value is
    computed once and not a second time for the test."""
    return df.select(*keep, F.explode(not_null(F.array(value))).alias(name))


def dense_distinct(array: Column) -> Column:
    """Elements present, the first of equal ones kept."""
    return F.array_distinct(present(array))


def first_positions(array: Column) -> Column:
    """``(item, seq)`` of the first of equal elements, ``seq`` the place in the
    whole array.  Sorting brings equal elements together: n log n, no shuffle."""
    placed = F.filter(
        F.transform(array, lambda x, i: F.struct(x.alias("item"), (i + 1).alias("seq"))),
        lambda e: e["item"].isNotNull() & (e["item"] != ""),
    )
    return let(
        F.sort_array(placed),
        lambda s: F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["item"] != e["item"], F.lit(True))),
    )


# Up to so many elements a list is searched from its start; longer ones are cut by hash.
_FEW = 64


def hash_share(value: Column, shares: Column) -> Column:
    return F.pmod(F.xxhash64(value), shares).cast("int")


def with_places(known: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use(place)``, where ``place(x)`` is the place of ``x`` in ``known``, counted from
    1, or 0.  A long list is cut into about as many pieces as a piece has elements, so a
    search reads one piece; lists of thousands cost no square of their length."""
    shares = F.ceil(F.sqrt(F.size(known))).cast("int")

    def cut(entries: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), shares - 1), lambda share: F.filter(entries, lambda e: e["share"] == share))

    placed = F.transform(known, lambda x, i: F.struct(x.alias("x"), (i + 1).cast("bigint").alias("place"), hash_share(x, shares).alias("share")))
    pieces = F.when(F.size(known) > _FEW, let(placed, cut))

    def place(pieces: Column, x: Column) -> Column:
        return F.when(pieces.isNull(), F.array_position(known, x)).otherwise(
            let(x, lambda x: F.coalesce(F.get(F.filter(F.get(pieces, hash_share(x, shares)), lambda e: e["x"] == x), 0)["place"], F.lit(0)))
        )

    return let(pieces, lambda pieces: use(lambda x: place(pieces, x)))


def text_from_positions(index: Column) -> Column:
    """Tokens put back at their positions and joined by spaces.

    When two tokens claim a position, the later one in document order has it.
    A token listed twice counts only where it is listed last.
    """
    def last_listed(entries: Column) -> Column:
        return let(
            F.transform(entries, lambda e: e["key"]),
            lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(
                F.filter(
                    entries,
                    lambda e, i: ~F.array_contains(
                        F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), e["key"]
                    ),
                )
            ),
        )

    def ordered(entries: Column) -> Column:
        # Only positions and ranks are sorted; tokens are fetched afterwards.
        placed = F.flatten(
            F.transform(
                entries,
                lambda e, i: F.transform(
                    F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("pos"), i.alias("rank"))
                ),
            )
        )
        winners = let(
            F.sort_array(placed),
            lambda s: F.filter(s, lambda e, j: F.coalesce(F.get(s, j + 1)["pos"] != e["pos"], F.lit(True))),
        )
        return F.transform(winners, lambda e: F.get(entries, e["rank"])["key"])

    return F.array_join(let(last_listed(F.map_entries(index)), ordered), " ")
