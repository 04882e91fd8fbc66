"""The pipeline stage by stage, each against what its operator says of the stage's input."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from starfold.llm import line_dedup, minhash, queries
from starfold.session import durable

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(registered.__file__))


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, FOLDER))
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_shrinking(stages):
    for docs in stages[:5]:
        assert docs.columns == stages[0].columns
    counts = [len(ids(d)) for d in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0


def test_rules(spark, stages):
    kept = {r.doc_id for r in queries.op5_quality_rules(spark, FOLDER).where("kept").collect()}
    assert ids(stages[1]) == sorted(kept)


def test_lines(stages):
    assert line_dedup.dropped_lines(stages[2]).where("edits = 0").count() == 0  # no line stands twice any more
    before = {r.doc_id: r.text for r in stages[1].collect()}
    gone = {(r.doc_id, r.line_no) for r in line_dedup.dropped_lines(stages[1]).collect()}
    for r in stages[2].collect():
        assert r.text == "\n".join(x for n, x in enumerate(before[r.doc_id].split("\n")) if (r.doc_id, n) not in gone) and r.n_chars == len(r.text)


def test_one_of_each_group(stages):
    kept = {r.doc_id for r in minhash.near_duplicates(stages[2]).where("kept").collect()}
    assert ids(stages[3]) == sorted(kept)


def test_mixing_repeats_nothing(stages):
    own = ids(stages[4])
    assert len(own) == len(set(own)) and set(own) <= set(ids(stages[3]))


def test_run_is_the_stages(spark, stages):
    key = lambda df: sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, FOLDER)) == key(stages[5])


def test_all_registered():
    names = registered.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(registered.oracle_sql()) <= set(names)


def test_library_stands_without_the_subpackage(tmp_path):
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "starfold", "tests", ".git"):
            os.symlink(os.path.join(ROOT, name), tmp_path / name)
    os.mkdir(tmp_path / "starfold")
    for name in os.listdir(os.path.join(ROOT, "starfold")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "starfold", name), tmp_path / "starfold" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(registered.__file__).read())
    code = "import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) > 100, out.stderr
