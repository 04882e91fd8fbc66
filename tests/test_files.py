import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from starfold.operators.catalogue import collect
from starfold.operators.diff import MergeConflict, fingerprint, merge_outputs, table_diff
from starfold.plans.job import EntityReport, Options, problems, repeated_ids, report_frame, run
from starfold.plans.registry import FEEDS, build
from starfold.sinks.delimited import write_delimited
from starfold.sources import snapshot as snapshot_source
from starfold.sources.documents import documents, malformed
from starfold.sources.snapshot import chosen_entities, merged_ids, scan


def put(root, entity, day, name, *lines):
    folder = root / entity / f"updated_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", encoding="utf-8") as f:
        f.writelines(line + "\n" for line in lines)


def record(i, **more):
    return json.dumps({"id": f"https://openalex.org/W{i}", **more})


@pytest.fixture
def snapshot(tmp_path):
    root = tmp_path / "snap"
    put(root, "works", "2024-02-01", "part_000.gz", record(5), record(6))
    put(root, "works", "2024-01-01", "part_001.gz", record(3), record(4))
    put(root, "works", "2024-01-01", "part_000.gz", record(1, title="a"), record(2))
    (root / "works" / "updated_date=2024-01-01" / "notes.txt").write_text("not read\n")
    return root


def in_order(lines):
    docs = documents(lines, "works", ())
    return [r["_id"] for r in docs.orderBy("_ord").collect()]


def test_scan_order_and_restrictions(spark, snapshot):
    root = str(snapshot)
    assert in_order(scan(spark, root, "works")) == [1, 2, 3, 4, 5, 6]
    assert in_order(scan(spark, root, "works", updated_dates=["2024-02-01", "2024-02-01", "1999-01-01"])) == [5, 6]
    assert in_order(scan(spark, root, "works", updated_dates=["1999-01-01"])) == []
    assert in_order(scan(spark, root, "works", max_files=2)) == [1, 2, 3, 4]
    assert in_order(scan(spark, root, "works", max_files=1, updated_dates=["2024-02-01"])) == [5, 6]
    assert in_order(scan(spark, root, "works", max_records=3)) == [1, 2, 3]
    assert in_order(scan(spark, root, "works", max_records=0)) == [1, 2, 3, 4, 5, 6]
    assert scan(spark, root, "authors").count() == 0


@pytest.mark.parametrize("records", range(1, 8))
def test_a_cap_opens_no_file_behind_its_batch(spark, snapshot, records):
    for day in range(2, 9):  # files that cannot be read: opening one fails
        folder = snapshot / "works" / f"updated_date=2024-03-0{day}"
        folder.mkdir()
        (folder / "part_000.gz").write_bytes(b"no gzip")
    if records <= 6:
        assert in_order(scan(spark, str(snapshot), "works", max_records=records)) == list(range(1, records + 1))
    else:
        with pytest.raises(Exception, match="(?i)eof|gzip|end of input"):
            scan(spark, str(snapshot), "works", max_records=records)


def test_batches_double(spark, tmp_path, monkeypatch):
    for i in range(9):
        put(tmp_path, "works", "2024-01-01", f"part_{i}.gz", record(2 * i + 1), record(2 * i + 2))
    opened = []
    real = snapshot_source.DataFrameReader.text
    monkeypatch.setattr(snapshot_source.DataFrameReader, "text", lambda self, paths, **more: opened.append(len(paths)) or real(self, paths, **more))
    assert in_order(scan(spark, str(tmp_path), "works", max_records=9)) == list(range(1, 10))
    # The listing; batches of 1, 2 and 4 files; then the four whole files, and the fifth alone.
    assert opened == [1, 1, 2, 4, 4, 1]


def test_the_scan_moves_no_text_to_rank_it(spark, tmp_path):
    for i in range(20):
        put(tmp_path, "works", f"2024-01-{i // 3 + 1:02}", f"part {i:03}%.gz", record(2 * i + 1), record(2 * i + 2))
    spark.conf.set("starfold.broadcastBytes", "0")
    try:
        lines = scan(spark, str(tmp_path), "works")
        assert in_order(lines) == list(range(1, 41))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("starfold.broadcastBytes")


def test_chosen_entities():
    assert chosen_entities(["topics", "works", "topics"]) == ["topics", "works"]
    assert len(chosen_entities(["topics", "all"])) == 11


def test_malformed_lines(spark):
    lines = spark.createDataFrame(
        [(1, '{"id":"W1"'), (2, ""), (3, "[1]"), (4, '{"id":"W4","title":7}'), (5, '{"id":"W5","ids":3}')], "_ord bigint, value string")
    assert sorted(r["_ord"] for r in malformed(lines, "works").collect()) == [1, 2, 3]
    assert sorted(r["_id"] for r in documents(lines, "works").collect()) == [4, 5]


GOOD = {
    "id": "W12", "title": "T", "display_name": "D", "biblio": {"volume": "1"}, "ids": {"pmid": 5}, "authorships": [{"author": {"id": "A5"}, "countries": ["x"]}],
    "open_access": {"oa_status": "gold"}, "primary_location": {"source": {"id": "S1"}}, "locations": [{"source": {"id": "S1"}}, {}],
    "abstract_inverted_index": {"z": [0], "b": [1], "a": [1]}, "referenced_works": ["W1", "W2"], "apc_list": {"value": 15}, "publication_year": 2020,
}


def plainly(value):
    """Collected values in a form that compares."""
    if isinstance(value, list):
        return [plainly(v) for v in value]
    return value.toPython() if hasattr(value, "toPython") else str(value)


SHAPES = [
    ("biblio", [], None), ("biblio", False, None), ("ids", "", None), ("authorships", {}, None), ("authorships", 0, None), ("open_access", False, None),
    ("abstract_inverted_index", [], None), ("abstract_inverted_index", {"z": [0.0], "b": [1.0], "a": [1.0]}, GOOD["abstract_inverted_index"]),
    ("referenced_works", "", None), ("apc_list", 0, None), ("title", False, None), ("title", [], None), ("title", 7, "7"), ("title", "[]", "[]"), ("title", "false", "false"),
    ("authorships", [{"author": [], "countries": ""}], [(None, None)]), ("authorships", [{"author": {"id": {}}, "countries": [{"a": 1}]}], [((None, None), ['{"a":1}'])]),
]


@pytest.mark.parametrize("field, value, wanted", SHAPES)
def test_a_field_of_another_type_is_absent(spark, field, value, wanted):
    def seen(doc):
        return {f: doc[f] for f in GOOD if f in doc and f != "id"}

    lines = spark.createDataFrame([(1, json.dumps(GOOD)), (2, json.dumps({**GOOD, field: value}))], "_ord bigint, value string")
    good, odd = (seen(r.asDict(recursive=True)) for r in documents(lines, "works").orderBy("_ord").collect())
    assert malformed(lines, "works").count() == 0
    found = odd.pop(field)
    if field == "authorships" and wanted:
        found = [(a["author"] and (a["author"]["id"], a["author"]["display_name"]), a["countries"]) for a in found]
    assert found == wanted
    good.pop(field)
    assert {k: plainly(v) for k, v in odd.items()} == {k: plainly(v) for k, v in good.items()}


def test_merged_ids_in_the_parent_folder(spark, snapshot):
    folder = snapshot.parent / "merged_ids" / "works"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("merge_date,id\n2024,https://openalex.org/W2\n2024,\n")
    with gzip.open(folder / "b.csv.gz", "wt") as f:
        f.write("id,merge_into_id\nW2,W1\n W3 ,W1\n")
    assert sorted(r[0] for r in merged_ids(spark, str(snapshot), "works").collect()) == ["W2", "W3"]
    assert merged_ids(spark, str(snapshot), "authors") is None


def cells(path, encoding="utf-8"):
    return [open(f"{path}/{f}", encoding=encoding, newline="").read() for f in sorted(os.listdir(path)) if f.startswith("part")]


def test_delimited_cells(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ' a "b"\tc\n', True, 1e-5), (2, None, False, None), (3, "x;y", None, 20000000.0)], "k int, t string, f boolean, d double"
    ).coalesce(1).withColumn("day", F.when(F.col("k") == 1, F.to_date(F.lit("2024-01-05"))))
    write_delimited(df, str(tmp_path / "t"))
    assert cells(tmp_path / "t") == ['k\tt\tf\td\tday\n1\t"a ""b"" c"\t1\t1e-05\t2024-01-05\n2\t\t0\t\t\n3\tx;y\t\t20000000.0\t\n']
    write_delimited(df.select("k", "t"), str(tmp_path / "u"), delimiter=";", encoding="UTF-16LE")
    assert cells(tmp_path / "u", "utf-16le") == ['k;t\n1;"a ""b"" c"\n2;\n3;"x;y"\n']
    with pytest.raises(ValueError):
        write_delimited(df, str(tmp_path / "v"), delimiter="::")


def test_diff_and_merge(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    other = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, table_diff(one, other).collect())) == [(1, "a", 1), (3, "c", -1)]
    merged, ignored = merge_outputs([("x", {"t": one, "r": one}), ("y", {"t": one.orderBy("v"), "r": other})], reference=["r"])
    assert set(merged) == {"t", "r"} and ignored == [("r", "y")]
    with pytest.raises(MergeConflict):
        merge_outputs([("x", {"t": one}), ("y", {"t": other})], reference=["r"])
    wide = one.select(F.col("k").cast("bigint").alias("k"), "v")
    assert merge_outputs([("x", {"t": one}), ("y", {"t": wide}), ("z", {"t": one})], reference=[], exact=True)[1] == []


def test_fingerprints(spark):
    def of(*rows):
        return fingerprint(spark.createDataFrame(rows, "a string, b string, c double"))

    assert of(("x", None, 1.0), ("y", "z", 2.0)) == of(("y", "z", 2.0), ("x", None, 1.0))
    differing = [of(("x", None, 1.0)), of((None, "x", 1.0)), of(("x", None, None)), of(("x", None, 1.0), ("x", None, 1.0)), of(("x", "", 1.0))]
    assert len(set(differing)) == 5 and fingerprint(spark.createDataFrame([], "a int")) == (0, 0, 0)


def test_repeated_keys_are_looked_for_in_repeated_documents(spark, docs_of):
    def work(i, *authors):
        return {"id": f"W{i}", "title": "t", "authorships": [{"raw_affiliation_strings": list(a)} for a in authors]}

    once = docs_of("works", work(1, "ab", "a"), work(2, "aa"))
    twice = docs_of("works", work(1, "ab"), work(2, "aa"), work(1, "c"))
    for docs, wanted in (
        (once, {"work": [], "work_author": [], "work_author_affiliation": [("repeated key", 1)]}),
        (twice, {"work": [("repeated key", 1)], "work_author": [("repeated key", 1)], "work_author_affiliation": [("repeated key", 2)]}),
    ):
        catalogue = collect({"works": docs}, FEEDS)
        for name, problems_of in wanted.items():
            made = build(name, {"works": docs}, catalogue)
            for repeated in (None, repeated_ids(docs)):
                assert [(r["problem"], r["n"]) for r in problems(name, made, repeated).collect()] == problems_of, name


def test_a_run(spark, snapshot, tmp_path):
    put(snapshot, "works", "2024-03-01", "part_000.gz", record(7, type="book", keywords=[{"keyword": "k"}]), '{"id":', "")
    folder = snapshot / "merged_ids" / "works"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id\nW2\n")
    options = Options(
        str(snapshot), str(tmp_path / "out"), str(tmp_path / "ids"), str(tmp_path / "staged"),
        entities=("works", "authors"), skip_merged=True)
    first = run(spark, Options(**{**options.__dict__, "collect_only": True}))
    assert first == {"works": EntityReport(9, 6, 1, 2), "authors": EntityReport(0, 0, 0, 0)}
    assert not (tmp_path / "out").exists()
    assert run(spark, options) == first
    assert report_frame(spark, first).count() == 2
    back = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out" / "work.csv"))
    assert sorted(int(r["work_id"]) for r in back.collect()) == [1, 3, 4, 5, 6, 7]
    assert spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "out" / "keyword.csv")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "staged" / "malformed" / "works"))
    assert sorted(r["value"] for r in bad.collect()) == ["", '{"id":']
    with pytest.raises(ValueError, match="malformed"):
        run(spark, Options(**{**options.__dict__, "strict": True}))


def test_a_stale_catalogue_is_reported(spark, snapshot, tmp_path):
    options = Options(str(snapshot), str(tmp_path / "out"), str(tmp_path / "ids"), str(tmp_path / "staged"),
                      entities=("works",), collect_only=True, strict=True)
    run(spark, options)
    put(snapshot, "works", "2024-03-01", "part_000.gz", record(8, type="new"))
    with pytest.raises(ValueError, match="catalogue"):
        run(spark, Options(**{**options.__dict__, "collect_only": False}))


def test_a_partial_catalogue_is_reported(spark, snapshot, tmp_path):
    put(snapshot, "institutions", "2024-03-01", "part_000.gz", json.dumps({"id": "I1", "type": "company", "display_name": "x"}))
    options = Options(str(snapshot), str(tmp_path / "out"), str(tmp_path / "ids"), str(tmp_path / "staged"), entities=("works",), collect_only=True)
    run(spark, options)
    wider = Options(**{**options.__dict__, "collect_only": False, "entities": ("works", "institutions")})
    with pytest.warns(UserWarning, match="institutions"):
        run(spark, wider)
    found = spark.read.parquet(str(tmp_path / "out" / "_checks" / "uncatalogued")).collect()
    assert {tuple(r) for r in found} == {("institutions", "(not collected)", 0), ("institutions", "institution_type", 1)}
    with pytest.raises(ValueError, match="institutions"):
        run(spark, Options(**{**wider.__dict__, "strict": True}))


def test_problems_are_written(spark, snapshot, tmp_path):
    put(snapshot, "works", "2024-03-01", "part_000.gz", record(8, publication_year=99999), record(8))
    options = Options(str(snapshot), str(tmp_path / "out"), str(tmp_path / "ids"), str(tmp_path / "staged"), entities=("works",))
    run(spark, options)
    found = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "_checks" / "tables" / "work")).collect()}
    assert found == {("work", "work_id", "repeated key", 1), ("work", "pub_year", "out of range", 1)}


def test_shared_folder_must_be_named_on_a_cluster(spark):
    from types import SimpleNamespace

    from starfold.session import shared_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        shared_folder(cluster)
