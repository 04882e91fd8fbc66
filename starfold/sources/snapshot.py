"""Scan of a snapshot: ``root/<entity>/updated_date=YYYY-MM-DD/*.gz``, one JSON
document per line (S1-S6, S10)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..fixed import ENTITIES
from ..functions import text as X
from ..operators.joins import drop_listed, known_small

_ROW_BITS = 33
_SCHEME = "^([A-Za-z0-9+.-]+):/+"
_LINES = "value string, _partition string, _ord bigint"


def chosen_entities(requested: Iterable[str]) -> list[str]:
    """``all`` stands for every entity in fixed order; else repeats go."""
    names = list(dict.fromkeys(requested))
    return list(ENTITIES) if "all" in names else names


def _one_slash(path: str) -> str:
    """Spark writes one path as ``file:/x`` or ``file:///x``, depending on who asks."""
    return re.sub(_SCHEME, r"\1:/", path)


def _scan_key(path: str) -> list[str]:
    """Partition first, then file name."""
    return [unquote(p) for p in path.rsplit("/", 2)]


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def scan(
    spark: SparkSession,
    root: str,
    entity: str,
    updated_dates: Iterable[str] | None = None,
    max_files: int | None = None,
    max_records: int | None = None,
) -> DataFrame:
    """Lines of an entity: ``value``, ``_partition`` (its date) and ``_ord``, the place in
    scan order (partition, file, line).

    A gzip file is read by one task from start to end, so the row number inside
    the task grows with the line; the file's rank goes in front of it.
    """
    folder = f"{root.rstrip('/')}/{entity}"
    nothing = spark.createDataFrame([], _LINES)
    if not exists(spark, folder):
        return nothing
    if updated_dates is None:
        parts = [f"{folder}/updated_date=*"]
    else:
        # Only the wanted partitions are listed; absent ones are passed over.
        wanted = [f"{folder}/updated_date={d}" for d in sorted(set(updated_dates))]
        parts = [p for p in wanted if exists(spark, p)]
    reader = (
        spark.read.option("pathGlobFilter", "*.gz").option("basePath", folder)
        .schema("value string, updated_date string")
    )
    # The file listing is metadata the driver holds already to plan the scan.
    every = sorted(reader.text(parts).inputFiles(), key=_scan_key) if parts else []
    files, cut = every[:max_files] if max_files else every, None
    if max_records and max_records > 0:
        files, cut = _first_files(reader, files, max_records)
    if not files:
        return nothing
    whole = files if cut is None else files[:-1]
    runs = list(_runs(whole, known_small(spark)))
    one = len(runs) == 1 and len(whole) == len(every)
    reads = [_numbered(reader, run, first, parts if one else None) for first, run in runs]
    if cut is not None:  # read alone, the lines of the last file count from 0
        last = _numbered(reader, files[-1:], len(files) - 1)
        reads.append(last.where(F.col("_row") < cut))
    ordered = reduce(DataFrame.unionByName, reads).select(
        "value", "_partition", (F.shiftleft("_file", _ROW_BITS) + F.col("_row")).alias("_ord")
    )
    # A gzip file is one task; few big files are shared out before the costly
    # parsing, while many files stay where they are and no text is moved.
    cores = spark.sparkContext.defaultParallelism
    return ordered.repartition(2 * cores) if cut is not None or len(files) < cores else ordered


def _runs(files: list[str], most: int) -> Iterator[tuple[int, list[str]]]:
    """Neighbouring files whose paths take ``most`` bytes, one file at least, and the rank
    of the first: the table of their ranks is always small enough to broadcast, so that no
    text is moved to learn its rank, however many files there are."""
    first, size = 0, 0
    for i, path in enumerate(files):
        if i > first and size + len(path) > most:
            yield first, files[first:i]
            first, size = i, 0
        size += len(path)
    if files:
        yield first, files[first:]


def _numbered(reader: DataFrameReader, files: list[str], first: int, folders: list[str] | None = None) -> DataFrame:
    """Lines of ``files`` (all there is in ``folders``, when given) with their file's rank,
    counted from ``first``, and a row number that grows inside a file."""
    lines = reader.text(folders or [unquote(path) for path in files])
    ranks = lines.sparkSession.createDataFrame(
        [(_one_slash(path), first + i) for i, path in enumerate(files)], "_path string, _file bigint"
    )
    numbered = lines.select(
        "value",
        F.col("updated_date").alias("_partition"),
        _path().alias("_path"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    return numbered.join(F.broadcast(ranks), "_path").drop("_path")


def _path() -> Column:
    return F.regexp_replace("_metadata.file_path", _SCHEME, "$1:/")


def _first_files(reader: DataFrameReader, files: list[str], records: int) -> tuple[list[str], int | None]:
    """The files that hold the first ``records`` lines, and how many lines of the last
    one count (None when all lines of all files do).

    Lines are counted file by file in scan order, in batches that double, so that a small
    cap opens few files and none behind the cap but those of its batch.  One number per
    file comes back.
    """
    taken, left, size = 0, records, 1
    while taken < len(files):
        batch = files[taken:taken + size]
        counts = reader.text([unquote(path) for path in batch]).groupBy(_path().alias("path")).agg(F.count(F.lit(1)).alias("n"))
        lines = {r["path"]: r["n"] for r in counts.collect()}
        for path in batch:
            taken += 1
            n = lines.get(_one_slash(path), 0)
            if n >= left:
                return files[:taken], left
            left -= n
        size *= 2
    return files, None


def merged_ids(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """Short ids of records merged into others, from the snapshot or its parent."""
    parent = root.rstrip("/").rsplit("/", 1)[0]
    base = next((p for p in (f"{root.rstrip('/')}/merged_ids", f"{parent}/merged_ids") if exists(spark, p)), None)
    if base is None or not exists(spark, f"{base}/{entity}"):
        return None
    # Files may differ in their columns; those with one header are read together.
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{base}/{entity}")
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    headers = placed.groupBy("path").agg(F.min_by("value", "place").alias("header"))
    alike: dict[str, list[str]] = {}
    for r in headers.collect():  # one row per file
        alike.setdefault(r["header"], []).append(unquote(r["path"]))
    reads = [
        spark.read.option("header", True).csv(paths).select("id")
        for header, paths in alike.items()
        if "id" in [name.strip('"') for name in header.split(",")]
    ]
    if not reads:
        return None
    rows = reduce(DataFrame.unionByName, reads)
    ids = rows.select(X.short_id(F.col("id")).alias("_short"))
    return ids.where(F.col("_short").isNotNull()).distinct()


def without_merged(docs: DataFrame, merged: DataFrame | None) -> DataFrame:
    """Documents whose short id is not listed; those without id pass."""
    return docs if merged is None else drop_listed(docs, merged, "_short")
