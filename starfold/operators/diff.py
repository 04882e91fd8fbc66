"""Comparing and merging copies of a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_once


def table_diff(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that occur more often in one table: ``surplus`` is positive when that is
    the first.  One grouping serves both directions and adds up before it shuffles."""
    signed = one.withColumn("surplus", F.lit(1)).unionByName(other.withColumn("surplus", F.lit(-1)))
    return signed.groupBy(*one.columns).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")


def fingerprint(df: DataFrame) -> tuple[int, Decimal, Decimal]:
    """Rows, and the sums of two 64-bit hashes of each: one pass, one row back, nothing
    but three numbers a task shuffled.  It is the same for the same rows in any order."""
    # A null leaves a hash as it is, so which columns are null is hashed as well.
    parts = [*df.columns, *[F.col(c).isNull() for c in df.columns]]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(i), *parts).cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")) for i in range(2)]
    return tuple(df.agg(F.count(F.lit(1)), *sums).first())


class MergeConflict(ValueError):
    """Copies of a table that should agree do not."""


def merge_outputs(
    copies: Iterable[tuple[str, Mapping[str, DataFrame]]], reference: Iterable[str], exact: bool = False
) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Merge the tables of several runs, in order: the first copy is kept.

    Equal copies are skipped.  A differing copy of a reference table is reported
    as ``(table, run)`` and ignored; of any other table, the merge fails.

    Each copy is read once, side by side, for its fingerprint.  Copies whose fingerprints
    differ are different; those that agree are taken as equal (a chance meeting of two
    64-bit sums aside), or, with ``exact``, compared row by row as well.
    """
    merged: dict[str, DataFrame] = {}
    others: list[tuple[str, str, DataFrame]] = []
    for run, tables in copies:
        for name, df in tables.items():
            if name in merged:
                # In the types of the first copy, as a number of another width has another hash.
                types = merged[name].schema
                others.append((name, run, df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in types])))
            else:
                merged[name] = df
    several = {name for name, _, _ in others}
    first = dict(zip(several, at_once(lambda n: fingerprint(merged[n]), several)))
    prints = at_once(lambda o: fingerprint(o[2]), others)
    ignored, conflicts = [], []
    lenient = set(reference)
    for (name, run, df), mark in zip(others, prints, strict=True):
        if mark != first[name] or (exact and not table_diff(merged[name], df).isEmpty()):
            (ignored if name in lenient else conflicts).append((name, run))
    if conflicts:
        raise MergeConflict(", ".join(f"{name} ({run})" for name, run in conflicts))
    return merged, ignored
