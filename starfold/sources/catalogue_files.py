"""Loading a saved catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalogue import CATALOGUES, Catalogue, CatalogueConfig
from ..session import at_once
from ..sinks.delimited import ENTITIES_FED, VALUES
from .snapshot import exists

def _separator(spark: SparkSession, path: str) -> str:
    """Tab when the header line holds one, else comma."""
    header = [r["value"] for r in spark.read.text(path).limit(1).collect()]
    return "\t" if any("\t" in line for line in header) else ","


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell may go on in the next line: then some line has an odd number
    of quotes, as quotes inside cells are doubled."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def _read(spark: SparkSession, path: str, config: CatalogueConfig) -> DataFrame:
    """Rows with a value and an integer id; of repeated values the last one counts.

    A file is cut into shares for many tasks unless a cell holds a line break, which
    only a reader that starts at the file's beginning can tell.
    """
    raw = (
        spark.read.option("header", True).option("sep", _separator(spark, path))
        .option("escape", '"').option("multiLine", has_broken_lines(spark, path))
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    rows = raw.select(
        F.lit(config.name).alias("catalogue"),
        config.cleaned(F.col(config.name)).alias("value"),
        F.col(config.id_column).try_cast("bigint").alias("id"),
        place.alias("_row"),
    ).where((F.col("value") != "") & F.col("id").isNotNull())
    return rows.groupBy("catalogue", "value").agg(F.max_by("id", "_row").alias("id"))


def _sized(assigned: DataFrame, parts: dict[str, DataFrame] | None, entities: frozenset[str] | None) -> Catalogue:
    size = F.sum(F.octet_length("value").cast("bigint") + 32).alias("n")
    # At most one row per configured catalogue comes back.
    sizes = {r["catalogue"]: r["n"] for r in assigned.groupBy("catalogue").agg(size).collect()}
    return Catalogue(assigned, sizes, parts=parts, entities=entities)


def load_catalogue(spark: SparkSession, folder: str) -> Catalogue | None:
    """The saved catalogue, or None unless it is complete.

    What this library saved is read from its Parquet; files of another origin are
    read as they are, and say nothing about the entities they cover.
    """
    root = folder.rstrip("/")
    paths = {c.name: f"{root}/{c.file_name}" for c in CATALOGUES.values()}
    if not all(exists(spark, p) for p in paths.values()):
        return None
    if exists(spark, f"{root}/{VALUES}/_SUCCESS"):
        saved = spark.read.parquet(f"{root}/{VALUES}")
        # One row per entity.
        entities = frozenset(r["value"] for r in saved.where(F.col("catalogue") == ENTITIES_FED).collect())
        return _sized(saved.where(F.col("catalogue") != ENTITIES_FED), None, entities)
    read = at_once(lambda c: _read(spark, paths[c.name], c), CATALOGUES.values())
    parts = dict(zip(CATALOGUES, read))
    return _sized(reduce(DataFrame.unionByName, parts.values()), parts, None)
