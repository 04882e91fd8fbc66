"""How an output table is declared: columns, key, what it reads, how it is built."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import numbered
from ..operators.catalogue import Catalogue

Build = Callable[[DataFrame, Catalogue], DataFrame]

_INTEGERS = {"smallint": 16, "int": 32, "bigint": 64}


@dataclass(frozen=True)
class OutputColumn:
    name: str
    declared: str
    required: bool

    @property
    def stored(self) -> str:
        """Integers are kept as bigint, so that a value outside the declared range
        reaches the range check (C2) instead of becoming null."""
        if self.declared in _INTEGERS:
            return "bigint"
        return "string" if self.length else self.declared

    @property
    def length(self) -> int | None:
        return int(self.declared[:-1].split("(")[1]) if "char(" in self.declared else None

    @property
    def bits(self) -> int | None:
        return _INTEGERS.get(self.declared)


def output_columns(ddl: str) -> tuple[OutputColumn, ...]:
    """``"name type [not null], ..."`` to columns."""
    columns = []
    for part in ddl.split(","):
        name, declared, *rest = part.split()
        columns.append(OutputColumn(name, declared, bool(rest)))
    return tuple(columns)


@dataclass(frozen=True)
class Table:
    name: str
    entity: str
    columns: tuple[OutputColumn, ...]
    key: tuple[str, ...]
    reads: tuple[str, ...]
    build: Build = field(repr=False)
    catalogues: tuple[str, ...] = ()
    # A key given here means that equal keys are merged, the first in scan order kept.
    shared: bool = False
    # The numbers in the key may repeat inside one document.
    repeats: bool = False

    @property
    def placed(self) -> bool:
        """Keys are a document and places in it, which differ by construction: a key can
        repeat only where a document was delivered twice."""
        return not self.shared and not self.repeats and all(k.endswith("_seq") for k in self.key[1:])


TABLES: dict[str, Table] = {}


def table(
    name: str,
    entity: str,
    columns: str,
    key: str,
    reads: str = "",
    catalogues: Sequence[str] = (),
    shared: bool = False,
    repeats: bool = False,
) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        TABLES[name] = Table(
            name, entity, output_columns(columns), tuple(key.split()), tuple(reads.split()),
            build, tuple(catalogues), shared, repeats,
        )
        return build

    return add


def child(
    name: str,
    entity: str,
    owner: str,
    seq: str,
    values: str,
    reads: str,
    items: Callable[[], Column],
    owner_type: str = "bigint",
) -> None:
    """A table with one row per element of a cleaned array, numbered 1..n.

    Elements are either the single value column or structs named like the columns.
    """
    names = [c.name for c in output_columns(values)]

    def build(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
        rows = numbered(docs, [F.col("_id").alias(owner)], items(), seq)
        taken = [F.col("item").alias(names[0])] if len(names) == 1 else [F.col("item")[n].alias(n) for n in names]
        return rows.select(owner, seq, *taken)

    ddl = f"{owner} {owner_type} not null, {seq} smallint not null, {values}"
    TABLES[name] = Table(name, entity, output_columns(ddl), (owner, seq), tuple(reads.split()), build)


def conform(df: DataFrame, columns: Sequence[OutputColumn]) -> DataFrame:
    """K2: declared order and types; missing columns are null, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(c.name).try_cast(c.stored) if c.name in present else F.lit(None).cast(c.stored)).alias(c.name)
            for c in columns
        ]
    )
