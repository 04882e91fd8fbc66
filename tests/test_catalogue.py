import os
import random

import pytest
from pyspark.sql import functions as F

from starfold.operators.catalogue import CATALOGUES, Catalogue, missing
from starfold.operators.dense_ids import dense_ids
from starfold.sinks.delimited import save_catalogue
from starfold.sources import catalogue_files
from starfold.sources.catalogue_files import load_catalogue


def catalogue_of(spark, pairs):
    assigned, sizes = dense_ids(spark.createDataFrame(pairs, "catalogue string, value string"))
    return Catalogue(assigned, sizes, fresh=True)


def ids_of(catalogue):
    return {(r["catalogue"], r["value"]): r["id"] for r in catalogue.assigned.collect()}


def test_order_is_folded_then_exact(spark):
    ids = ids_of(catalogue_of(spark, [("x", v) for v in ("b", "B", "a", "straße", "STRASSE", "strasse", "Ω", "ω")]))
    wanted = sorted({v for _, v in ids}, key=lambda v: (v.casefold(), v))
    assert [ids["x", v] for v in wanted] == list(range(1, len(wanted) + 1))


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_ids_do_not_depend_on_partitions(spark, partitions):
    rng = random.Random(5)
    # A third of the values start alike, and one group has nearly all of them.
    values = {("many", ("the " if i % 3 else "") + "".join(rng.choice("abcABCéÉß") for _ in range(6))) for i in range(3000)}
    pairs = sorted(values | {("few", v) for v in ("z", "Y", "x")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ids = ids_of(catalogue_of(spark, pairs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    for group in ("many", "few"):
        ordered = sorted((v for g, v in pairs if g == group), key=lambda v: (v.casefold(), v))
        assert [ids[group, v] for v in ordered] == list(range(1, len(ordered) + 1))


def test_lookup_by_shuffle_equals_lookup_by_broadcast(spark):
    rows = spark.range(3000).select(
        "id",
        # A third has one value, a third none, the rest are spread or unknown.
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE 'v' || (id % 400) END").alias("text"),
    ).withColumnRenamed("id", "k")
    pairs = [("raw_author_name", f"v{i}") for i in range(300)] + [("raw_author_name", "hot")]
    results = []
    for limit in (str(32 << 20), "0"):
        spark.conf.set("starfold.broadcastBytes", limit)
        found = catalogue_of(spark, pairs).lookup(rows, "raw_author_name", F.col("text"), "name_id")
        assert found.columns == ["k", "text", "name_id"]
        results.append(sorted(map(tuple, found.collect()), key=lambda r: r[0]))
    spark.conf.unset("starfold.broadcastBytes")
    assert results[0] == results[1]
    assert len(results[0]) == 3000


def test_missing_values(spark):
    catalogue = catalogue_of(spark, [("license", "a")])
    used = spark.createDataFrame([("license", "a"), ("license", "b"), ("version", "a")], "catalogue string, value string")
    assert sorted(map(tuple, missing(used, catalogue).collect())) == [("license", "b"), ("version", "a")]


def test_saved_and_loaded(spark, tmp_path):
    odd = [("keyword", " lead"), ("keyword", "trail "), ("keyword", "two\nlines"), ("raw_author_name", "\t")]
    catalogue = catalogue_of(spark, [("license", "a"), ("license", 'q"u\\o'), ("raw_affiliation_string", "x, y"), *odd])
    folder = str(tmp_path / "ids")
    assert load_catalogue(spark, folder) is None
    save_catalogue(catalogue, folder, ["works", "authors"])
    assert sorted(f for f in os.listdir(folder) if f[0] != "_") == sorted(c.file_name for c in CATALOGUES.values())
    for c in CATALOGUES.values():
        part = [f for f in os.listdir(f"{folder}/{c.file_name}") if f.startswith("part")]
        assert part and open(f"{folder}/{c.file_name}/{sorted(part)[0]}").readline() == f"{c.id_column}\t{c.name}\n"
    loaded = load_catalogue(spark, folder)
    assert ids_of(loaded) == ids_of(catalogue) and loaded.entities == {"works", "authors"}
    os.rename(f"{folder}/_values", f"{tmp_path}/_values")  # the exported files alone hold the same
    exported = load_catalogue(spark, folder)
    assert ids_of(exported) == ids_of(catalogue) and exported.entities is None
    os.rename(f"{folder}/region.csv", f"{folder}/elsewhere")
    assert load_catalogue(spark, folder) is None


def test_a_broken_write_is_no_catalogue(spark, tmp_path):
    folder = str(tmp_path / "ids")
    save_catalogue(catalogue_of(spark, [("license", "a")]), folder, ["works"])
    os.remove(f"{folder}/_values/_SUCCESS")
    assert load_catalogue(spark, folder).entities is None  # only the exported files are left to read


def test_foreign_files_are_read_in_shares(spark, tmp_path):
    config = CATALOGUES["raw_author_name"]
    path = str(tmp_path / config.file_name)
    with open(path, "w") as f:
        f.write("raw_author_name_id\traw_author_name\n" + "".join(f'{i}\tName "" {i % 700}\n' if i % 2 else f'{i}\t"Na ""me"" {i % 700}"\n' for i in range(2100)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert not catalogue_files.has_broken_lines(spark, path)
        rows = catalogue_files._read(spark, path, config)
        found = {r["value"]: r["id"] for r in rows.collect()}
        assert len(found) == 700 and all(1400 <= i < 2100 for i in found.values())  # of repeated values the last counts
        plain = spark.read.option("header", True).option("sep", "\t").option("escape", '"').csv(path)
        assert plain.rdd.getNumPartitions() > 5
        with open(path, "a") as f:
            f.write('9999\t"two\nlines"\n')
        assert catalogue_files.has_broken_lines(spark, path)
        assert {r["value"]: r["id"] for r in catalogue_files._read(spark, path, config).collect()}["two\nlines"] == 9999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_foreign_catalogue_files(spark, tmp_path):
    for c in CATALOGUES.values():
        text = f"{c.id_column},{c.name}\n"
        if c.name == "license":
            text = "﻿" + text + "1, a \nx,b\n3,\n,d\n4,e\n9,e\n"
        (tmp_path / c.file_name).write_text(text, encoding="utf-8")
    loaded = load_catalogue(spark, str(tmp_path))
    assert ids_of(loaded) == {("license", "a"): 1, ("license", "e"): 9}
