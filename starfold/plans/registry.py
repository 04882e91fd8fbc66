"""All 88 output tables and what feeds the catalogues."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.catalogue import CATALOGUES, Catalogue, values_of
from . import authors, concepts, funders, institutions, sources, taxonomy, works  # noqa: F401
from . import derived  # noqa: F401
from .tables import TABLES, Table, conform, output_columns, table

FEEDS = (*works.FEEDS, *institutions.FEEDS, *sources.FEEDS)

# Enumerations whose rows come from the catalogue alone.  Goals are also an
# enumeration, but nothing looks them up; their table comes from the works.
ENUMERATIONS = [c.name for c in CATALOGUES.values() if c.enumeration and c.name not in TABLES]
NAMESPACES = [c.name for c in CATALOGUES.values() if not c.enumeration]


def _feeds_of(name: str) -> tuple[str, str]:
    feeds = [f for f in FEEDS if f.catalogue == name]
    return feeds[0].entity, " ".join(r for f in feeds for r in f.reads)


def _columns(name: str) -> str:
    c = CATALOGUES[name]
    return f"{c.id_column} {c.id_type} not null, {name} {c.width}"


for _name in ENUMERATIONS:
    _entity, _reads = _feeds_of(_name)
    table(_name, _entity, _columns(_name), key=f"{_name}_id", reads=_reads, catalogues=(_name,))(
        lambda _docs, catalogue, name=_name: catalogue.table(name)
    )


def _namespace(docs: DataFrame, catalogue: Catalogue, name: str, entity: str) -> DataFrame:
    """Values in use by these documents, each once, with their ids."""
    if catalogue.fresh:
        return catalogue.table(name)
    used = values_of({entity: docs}, FEEDS, [name]).select("value")
    rows = catalogue.lookup(used, name, used["value"], f"{name}_id")
    return rows.withColumnRenamed("value", name)


for _name in NAMESPACES:
    _entity, _reads = _feeds_of(_name)
    table(_name, _entity, _columns(_name), key=f"{_name}_id", reads=_reads, catalogues=(_name,), shared=True)(
        lambda docs, catalogue, name=_name, entity=_entity: _namespace(docs, catalogue, name, entity)
    )


def fields_read(t: Table) -> set[str]:
    """Document fields needed for a table, its catalogues included."""
    feeds = [f for f in FEEDS if f.catalogue in t.catalogues and f.entity == t.entity]
    return set(t.reads).union(*[f.reads for f in feeds]) if feeds else set(t.reads)


def build(name: str, docs: Mapping[str, DataFrame], catalogue: Catalogue | None) -> DataFrame:
    """A table in its declared shape."""
    t = TABLES[name]
    return conform(t.build(docs[t.entity], catalogue), t.columns)


__all__ = ["ENUMERATIONS", "FEEDS", "NAMESPACES", "TABLES", "build", "fields_read", "output_columns"]
