"""Catalogues: which id stands for which text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import not_null
from ..functions.text import strip
from .dense_ids import dense_ids
from .joins import known_small, left_with_nulls_spread


@dataclass(frozen=True)
class CatalogueConfig:
    """An enumeration (few values, trimmed) or a namespace (many values, kept as they are)."""

    name: str
    width: str
    id_type: str = "smallint"
    enumeration: bool = True
    normalise: Callable[[Column], Column] | None = None

    @property
    def id_column(self) -> str:
        return f"{self.name}_id"

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv" if self.enumeration else f"{self.name}_ids.csv"

    def cleaned(self, value: Column) -> Column:
        """The value as it is catalogued; an empty one is in no catalogue."""
        return (self.normalise or strip)(value) if self.enumeration else value


# Names, declared widths and id types of the catalogues.
CATALOGUES = {
    c.name: c
    for c in (
        CatalogueConfig("work_type", "varchar(25)"),
        CatalogueConfig("doi_registration_agency", "varchar(20)"),
        CatalogueConfig("oa_status", "varchar(10)"),
        CatalogueConfig("apc_provenance", "varchar(20)"),
        CatalogueConfig("fulltext_origin", "varchar(20)"),
        CatalogueConfig("data_source", "varchar(20)", "int"),
        CatalogueConfig("version", "varchar(16)"),
        CatalogueConfig("license", "varchar(60)"),
        CatalogueConfig("author_position", "varchar(6)"),
        CatalogueConfig("sustainable_development_goal", "varchar(40)"),
        CatalogueConfig("institution_type", "varchar(10)"),
        CatalogueConfig("institution_relationship_type", "varchar(15)"),
        CatalogueConfig("region", "varchar(50)"),
        CatalogueConfig("source_type", "varchar(14)"),
        CatalogueConfig("keyword", "varchar(200)", "int", enumeration=False),
        CatalogueConfig("raw_affiliation_string", "string", "bigint", enumeration=False),
        CatalogueConfig("raw_author_name", "string", "bigint", enumeration=False),
    )
}


@dataclass(frozen=True)
class Feed:
    """Where values of a catalogue come from: an array of texts per document."""

    catalogue: str
    entity: str
    reads: tuple[str, ...]
    values: Callable[[], Column]


class Catalogue:
    """Assignments ``(catalogue, value, id)`` and the measured bytes of each catalogue."""

    def __init__(
        self,
        assigned: DataFrame,
        sizes: Mapping[str, int],
        fresh: bool = False,
        parts: Mapping[str, DataFrame] | None = None,
        entities: Iterable[str] | None = None,
    ) -> None:
        self.assigned = assigned
        self._parts = parts
        self.sizes = dict(sizes)
        # Fresh: collected from the very documents it is used on.
        self.fresh = fresh
        # The entities it was collected from; None when that is not known.
        self.entities = None if entities is None else frozenset(entities)
        self._limit = known_small(assigned.sparkSession)

    def part(self, name: str) -> DataFrame:
        if self._parts is not None:
            return self._parts[name].select("value", "id")
        return self.assigned.where(F.col("catalogue") == name).select("value", "id")

    def table(self, name: str) -> DataFrame:
        """The enumeration as its own output table."""
        return self.part(name).select(F.col("id").alias(f"{name}_id"), F.col("value").alias(name))

    def lookup(self, df: DataFrame, name: str, value: Column, out: str) -> DataFrame:
        """Add ``out``: the id of ``value``, null when blank or unknown (unknown ones
        are reported by :func:`missing`).  Parts measured small are broadcast, the
        others joined by a shuffle on the text."""
        key = f"_key_{out}"
        side = self.part(name).select(F.col("value").alias(key), F.col("id").alias(out))
        value = CATALOGUES[name].cleaned(value)
        if self.sizes.get(name, 0) <= self._limit:
            return df.join(F.broadcast(side), value == F.col(key), "left").drop(key)
        return left_with_nulls_spread(df, value, side, key)


def _entries(feed: Feed) -> Column:
    """Distinct values of one document as ``(catalogue, value)``."""
    config = CATALOGUES[feed.catalogue]
    cleaned = F.array_distinct(not_null(F.transform(feed.values(), config.cleaned)))
    return F.transform(
        cleaned, lambda v: F.struct(F.lit(config.name).alias("catalogue"), v.alias("value"))
    )


def values_of(
    docs: Mapping[str, DataFrame], feeds: Iterable[Feed], names: Iterable[str] | None = None
) -> DataFrame:
    """Distinct ``(catalogue, value)`` over all entities, one pass each."""
    wanted = set(CATALOGUES if names is None else names)
    found = None
    for entity, df in docs.items():
        entries = [
            _entries(f) for f in feeds if f.entity == entity and f.catalogue in wanted
        ]
        if not entries:
            continue
        rows = df.select(F.explode(F.concat(*entries)).alias("e")).select("e.*").where(F.col("value") != "")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        spark = next(iter(docs.values())).sparkSession
        return spark.createDataFrame([], "catalogue string, value string")
    return found.distinct()


def collect(
    docs: Mapping[str, DataFrame], feeds: Iterable[Feed], names: Iterable[str] | None = None
) -> Catalogue:
    """Collect and number the values."""
    assigned, sizes = dense_ids(values_of(docs, feeds, names))
    return Catalogue(assigned, sizes, fresh=True)


def missing(values: DataFrame, catalogue: Catalogue) -> DataFrame:
    """``(catalogue, value)`` in use but not assigned."""
    return values.join(catalogue.assigned, ["catalogue", "value"], "left_anti")
