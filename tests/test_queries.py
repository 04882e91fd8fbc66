"""Registered queries against their SQL.  A sample by default; STARFOLD_ALL=1 runs all."""

import os
import subprocess
import sys

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry_points  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "t_work t_work_location t_work_author t_work_abstract t_work_affiliation_institution t_citation t_work_detail "
    "t_country t_source_issn t_topic_sibling q_seq_positional_distinct q_namespace_lookup q_scan_order q_table_diff "
    "q_delimited_files q_catalogue_reload"
).split()
NAMES = sorted(entry_points.queries()) if os.environ.get("STARFOLD_ALL") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def shown(rows):
    return sorted([tuple((type(v).__name__, repr(v)) for v in r) for r in rows])


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, database, name):
    df = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = database.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = shown([r[i] for i in order] for r in result.fetchall())
    assert shown(tuple(r[c] for c in columns) for r in df.collect()) == wanted


def test_every_query_has_sql():
    # The operators for training data, when there, are held against plain versions in their own tests.
    own = {name for name in entry_points.queries() if name.startswith(("t_", "q_"))}
    assert own == {name for name in entry_points.oracle_sql() if name.startswith(("t_", "q_"))}
    assert len(own) >= 135


def test_without_the_operators_for_training_data():
    """They can be taken away, or fail to import; all other queries stay."""
    hide = "import sys; sys.modules['starfold.llm'] = None; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    found = subprocess.run([sys.executable, "-c", hide, root], capture_output=True, text=True, check=True).stdout.split()
    own = {name for name in entry_points.queries() if name.startswith(("t_", "q_"))}
    assert found == [str(len(own))] * 2


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
