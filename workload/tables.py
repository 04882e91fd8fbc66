"""One registered query per output table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.catalogue import collect
from starfold.plans.registry import FEEDS, TABLES, build, fields_read
from starfold.session import durable
from starfold.sources.documents import documents

from .abstracts import abstract_lines
from .fixtures import AUTHORSHIPS, LINKED_AUTHORSHIPS, lines

ACROSS_WORKS = ("citation", "work_detail")

Query = Callable[[SparkSession, str], DataFrame]


def as_exported(df: DataFrame) -> DataFrame:
    """Flags as 1/0 and dates as text, the way the delimited files have them."""
    shown = {"boolean": lambda c: c.cast("bigint"), "date": lambda c: F.date_format(c, "yyyy-MM-dd")}
    return df.select(*[shown.get(t, lambda c: c)(F.col(n)).alias(n) for n, t in df.dtypes])


def table_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = TABLES[name]
        if name == "work_abstract":
            text = abstract_lines(spark, sf_dir)
        else:
            linked = name == "work_affiliation_institution"
            shown = LINKED_AUTHORSHIPS if linked else AUTHORSHIPS
            text = lines(spark, sf_dir, t.entity, shown, fields_read(t))
        parsed = documents(text, t.entity, fields_read(t))
        # Read more than once: staged first, as in a full run.
        docs = {t.entity: durable(parsed) if t.catalogues or name in ACROSS_WORKS else parsed}
        catalogue = collect(docs, FEEDS, t.catalogues) if t.catalogues else None
        return as_exported(build(name, docs, catalogue))

    return run
