"""Checks that count what the schema forbids (C1, C2); nothing is changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import known_small


def null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows in which a part of the key is missing."""
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return df.where(missing)


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def of_repeated_documents(df: DataFrame, owner: str, repeated: DataFrame) -> DataFrame:
    """Rows whose document was delivered more than once: all among which a key made of
    the document and places in it can repeat.  The list of ids is broadcast only when
    measured small."""
    ids = repeated.withColumnRenamed(repeated.columns[0], owner)
    small = ids.count() * 16 <= known_small(df.sparkSession)
    return df.join(F.broadcast(ids) if small else ids, owner, "left_semi")


def column_problems(df: DataFrame, columns: Sequence) -> DataFrame:
    """``(column_name, problem, n)`` for texts longer than declared, integers
    outside the declared range and nulls where none are allowed; one pass."""
    tests = []
    for c in columns:
        if c.required:
            tests.append((c.name, "null", F.col(c.name).isNull()))
        if c.length:
            tests.append((c.name, "too long", F.char_length(c.name) > c.length))
        if c.bits and c.bits < 64:
            top = 1 << (c.bits - 1)
            tests.append((c.name, "out of range", ~F.col(c.name).between(-top, top - 1)))
    counts = df.agg(*[F.count_if(t).alias(f"t{i}") for i, (_, _, t) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.lit(p).alias("problem"), F.col(f"t{i}").alias("n"))
            for i, (n, p, _) in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows)).where("n > 0")
