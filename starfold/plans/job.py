"""The whole run: scan, stage, collect ids, write tables, check, report."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.catalogue import Catalogue, collect, missing, values_of
from ..operators.checks import column_problems, null_keys, of_repeated_documents, repeated_keys
from ..session import at_once, durable
from ..sinks.delimited import save_catalogue, write_delimited
from ..sources.catalogue_files import load_catalogue
from ..sources.documents import all_documents, malformed
from ..sources.snapshot import chosen_entities, merged_ids, scan, without_merged
from .registry import ENUMERATIONS, FEEDS, TABLES, build


@dataclass(frozen=True)
class Options:
    """Parameters of a run; the folders are reachable by all executors."""

    snapshot: str
    output: str
    reference: str
    staging: str
    entities: tuple[str, ...] = ("all",)
    updated_dates: tuple[str, ...] | None = None
    max_files: int | None = None
    max_records: int | None = None
    skip_merged: bool = False
    collect_only: bool = False
    encoding: str = "UTF-8"
    delimiter: str = "\t"
    strict: bool = False
    check: bool = True
    tables_at_once: int = 4


@dataclass(frozen=True)
class EntityReport:
    read: int
    processed: int
    skipped_merged: int
    malformed: int


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def stage(spark: SparkSession, options: Options, entity: str) -> tuple[DataFrame, EntityReport]:
    """Read and parse an entity's text once, into typed nested Parquet.

    Every table then reads only the nested columns it needs.  Counts are taken
    on the way, without a pass of their own.
    """
    lines = scan(
        spark, options.snapshot, entity, options.updated_dates, options.max_files, options.max_records
    )
    lines, read = _counted(lines)
    docs, good = _counted(all_documents(lines, entity))
    merged = merged_ids(spark, options.snapshot, entity) if options.skip_merged else None
    kept, processed = _counted(without_merged(docs, merged))
    path = f"{options.staging.rstrip('/')}/{entity}"
    kept.where(F.col("_id").isNotNull()).write.mode("overwrite").parquet(path)

    n_read, n_good, n_kept = (o.get["n"] for o in (read, good, processed))
    report = EntityReport(n_read, n_kept, n_good - n_kept, n_read - n_good)
    if report.malformed:
        if options.strict:
            raise ValueError(f"{entity}: {report.malformed} malformed lines")
        bad = malformed(
            scan(spark, options.snapshot, entity, options.updated_dates, options.max_files, options.max_records),
            entity,
        )
        bad.write.mode("overwrite").parquet(f"{options.staging.rstrip('/')}/malformed/{entity}")
    return spark.read.parquet(path), report


def ids_for(spark: SparkSession, options: Options, docs: dict[str, DataFrame]) -> Catalogue:
    """A complete saved catalogue is reused; else values are collected and saved."""
    saved = load_catalogue(spark, options.reference)
    if saved is not None:
        return saved
    catalogue = collect(docs, FEEDS)
    save_catalogue(catalogue, options.reference, docs)
    return catalogue


def uncatalogued(spark: SparkSession, docs: dict[str, DataFrame], catalogue: Catalogue) -> DataFrame:
    """C3 for a reused catalogue: ``(entity, catalogue, n)``, the number of values in use
    that have no id.  Entities the catalogue was not collected from are named with 0, too."""
    found = spark.createDataFrame([], "entity string, catalogue string, n bigint")
    for entity, df in docs.items():
        lacking = missing(values_of({entity: df}, FEEDS), catalogue).groupBy("catalogue").agg(F.count(F.lit(1)).alias("n"))
        found = found.unionByName(lacking.select(F.lit(entity).alias("entity"), "catalogue", "n"))
        if catalogue.entities is not None and entity not in catalogue.entities:
            found = found.unionByName(spark.createDataFrame([(entity, "(not collected)", 0)], found.schema))
    return found


def repeated_ids(docs: DataFrame) -> DataFrame:
    """Ids of documents delivered more than once; eight bytes a document are shuffled."""
    return durable(repeated_keys(docs.select("_id"), ["_id"]).select("_id"))


def problems(name: str, table: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """C1, C2 for one output table: ``(table_name, column_name, problem, n)``.

    With the ``repeated`` ids of the entity's documents, a table whose keys differ by
    construction inside a document is grouped only where a document came twice.
    """
    declared = TABLES[name]
    key = ",".join(declared.key)
    held = table.where(" and ".join(f"{k} is not null" for k in declared.key))
    if repeated is not None and declared.placed:
        held = of_repeated_documents(held, declared.key[0], repeated)
    counted = [
        null_keys(table, declared.key).agg(F.lit(key).alias("column_name"), F.lit("null key").alias("problem"), F.count(F.lit(1)).alias("n")),
        repeated_keys(held, declared.key).agg(F.lit(key).alias("column_name"), F.lit("repeated key").alias("problem"), F.count(F.lit(1)).alias("n")),
        column_problems(table, declared.columns),
    ]
    every = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return every.where("n > 0").select(F.lit(name).alias("table_name"), "column_name", "problem", "n")


def run(spark: SparkSession, options: Options) -> dict[str, EntityReport]:
    """A full run; returns what was read, per entity in the order asked for."""
    entities = chosen_entities(options.entities)
    docs, reports = {}, {}
    for entity in entities:
        docs[entity], reports[entity] = stage(spark, options, entity)
    catalogue = ids_for(spark, options, docs)
    if options.collect_only:
        return reports

    checks = f"{options.output.rstrip('/')}/_checks"
    if not catalogue.fresh:
        uncatalogued(spark, docs, catalogue).write.mode("overwrite").parquet(f"{checks}/uncatalogued")
        lacking = {r["entity"] for r in spark.read.parquet(f"{checks}/uncatalogued").select("entity").distinct().collect()}
        if lacking:
            said = f"the saved catalogue lacks values of {', '.join(sorted(lacking))}; collect it again ({checks}/uncatalogued)"
            if options.strict:
                raise ValueError(said)
            warnings.warn(said, stacklevel=2)

    # Enumerations are written whatever entities were asked for.
    names = [n for n, t in TABLES.items() if t.entity in docs or n in ENUMERATIONS]
    repeated = dict(zip(docs, at_once(repeated_ids, docs.values(), options.tables_at_once))) if options.check else {}

    def write(name: str) -> None:
        table = catalogue.table(name) if name in ENUMERATIONS else build(name, docs, catalogue)
        if options.check and name not in ENUMERATIONS:
            # Made once, then written out and checked.
            made = f"{options.staging.rstrip('/')}/tables/{name}"
            table.write.mode("overwrite").parquet(made)
            table = spark.read.parquet(made)
            problems(name, table, repeated[TABLES[name].entity]).write.mode("overwrite").parquet(f"{checks}/tables/{name}")
        write_delimited(table, f"{options.output.rstrip('/')}/{name}.csv", options.delimiter, options.encoding)

    at_once(write, names, options.tables_at_once)
    return reports


def report_frame(spark: SparkSession, reports: dict[str, EntityReport]) -> DataFrame:
    """K7 as a table: one row per entity."""
    rows = [(e, r.read, r.processed, r.skipped_merged, r.malformed) for e, r in reports.items()]
    return spark.createDataFrame(
        rows, "entity string, read bigint, processed bigint, skipped_merged bigint, malformed bigint"
    )


__all__: Iterable[str] = ["EntityReport", "Options", "ids_for", "report_frame", "run", "stage"]
