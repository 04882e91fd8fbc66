import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs_of(spark):
    """Documents of an entity from Python objects or ready JSON text."""
    import json

    from starfold.sources.documents import documents

    def make(entity, *records, fields=None):
        rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
        return documents(spark.createDataFrame(rows, "_ord bigint, value string"), entity, fields)

    return make


@pytest.fixture
def table_of(docs_of):
    """An output table of hand-written records, as a list of tuples of chosen columns."""
    from starfold.operators.catalogue import collect
    from starfold.plans.registry import FEEDS, TABLES, build

    def make(name, *records, columns=None):
        t = TABLES[name]
        docs = {t.entity: docs_of(t.entity, *records)}
        catalogue = collect(docs, FEEDS, t.catalogues) if t.catalogues else None
        df = build(name, docs, catalogue)
        rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
        return sorted(rows, key=lambda r: [(v is not None, v) for v in r])

    return make
