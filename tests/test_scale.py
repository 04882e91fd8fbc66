"""Plans that must hold when the data is a thousand times larger."""

import contextlib
import time

from pyspark.sql import functions as F

from starfold.operators.catalogue import Catalogue
from starfold.operators.dense_ids import dense_ids
from starfold.operators.first_wins import first_wins
from starfold.plans import derived
from starfold.plans.derived import citations, edges
from starfold.plans.registry import build
from starfold.session import durable
from starfold.sources.documents import documents


@contextlib.contextmanager
def settings(spark, **values):
    old = {}
    for name, value in values.items():
        key = name.replace("_", ".")
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Thresholds a thousand times smaller than usual, and nothing small enough to broadcast.
TINY = dict(
    spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="2k",
    spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.2",
    spark_sql_adaptive_advisoryPartitionSizeInBytes="1k",
    spark_sql_autoBroadcastJoinThreshold="-1",
    starfold_broadcastBytes="0",
)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def works(spark, n):
    # A third of all references go to one work.
    text = F.to_json(F.struct(
        F.concat(F.lit("W"), "id").alias("id"),
        (F.lit(2000) + F.col("id") % 20).cast("string").alias("publication_year"),
        F.array(F.struct(F.struct(F.concat(F.lit("A"), F.col("id") % 50).alias("id")).alias("author"))).alias("authorships"),
        F.array(F.lit("W1"), F.concat(F.lit("W"), (F.col("id") * 7) % n), F.lit(None).cast("string")).alias("referenced_works"),
    ))
    lines = spark.range(n).select(F.col("id").alias("_ord"), text.alias("value"))
    return durable(documents(lines, "works", ("publication_year", "authorships", "referenced_works")))


def test_a_work_cited_very_often_is_split(spark):
    docs = works(spark, 4000)
    plain = sorted(map(tuple, citations(docs).collect()))
    with settings(spark, **TINY):
        split = edges(docs)
        assert sorted(tuple(r)[:6] for r in split.collect()) == plain
        assert "skew=true" in final_plan(split)
    assert len(plain) == 12000
    assert sum(r[5] or False for r in plain if r[2] == 1) == 80


def test_a_hot_value_is_split_in_lookups(spark):
    rows = durable(spark.range(6000).select(
        "id", F.expr("CASE id % 3 WHEN 0 THEN 'a name of many authors' WHEN 1 THEN NULL ELSE 'v' || id END").alias("text")))
    values = rows.where("text IS NOT NULL").select(F.lit("raw_author_name").alias("catalogue"), F.col("text").alias("value")).distinct()
    with settings(spark, **TINY):
        catalogue = Catalogue(*dense_ids(values), fresh=True)
        found = catalogue.lookup(rows, "raw_author_name", F.col("text"), "name_id")
        got = found.collect()
        assert "skew=true" in final_plan(found)
    assert len(got) == 6000
    assert len({r["name_id"] for r in got}) == 2001 + 1


def test_values_alike_in_front_are_cut_evenly(spark):
    values = spark.range(5000).select(F.lit("keyword").alias("catalogue"), F.concat(F.lit("university of the "), "id").alias("value"))
    with settings(spark, spark_sql_shuffle_partitions="8", spark_sql_adaptive_coalescePartitions_enabled="false"):
        ids, _ = dense_ids(values)
        sizes = [r["count"] for r in ids.groupBy("id").count().collect()]
    assert len(sizes) == 5000 and max(sizes) == 1


def test_first_wins_shrinks_by_hash_before_it_sorts(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "'x' || id % 2 AS v", "id AS at")
    df = first_wins(rows, ["k"], ["v"], "at")
    assert sorted(map(tuple, df.collect())) == [(0, "x0"), (1, "x1"), (2, "x0")]
    assert "HashAggregate(keys=[k" in final_plan(df)


def test_child_tables_do_not_shuffle(spark, docs_of):
    docs = docs_of("works", {"id": "W1", "authorships": [{"raw_affiliation_strings": ["a"]}], "abstract_inverted_index": {"a": [0]}})
    for name in ("work_reference", "work_abstract", "work_affiliation_institution", "work_author_affiliation", "work_title"):
        assert "Exchange" not in final_plan(build(name, {"works": docs}, None)), name


def test_staged_documents_are_read_by_nested_columns(spark, docs_of):
    docs = durable(docs_of("works", {"id": "W1", "concepts": [{"id": "C1"}], "title": "t"}))
    plan = final_plan(build("work_concept", {"works": docs}, None))
    assert "concepts" in plan.split("ReadSchema")[1] and "title" not in plan.split("ReadSchema")[1]


def test_two_tables_read_one_table_of_edges(spark, monkeypatch):
    docs, made = works(spark, 200), []
    monkeypatch.setattr(derived, "edges", lambda d: made.append(1) or edges(d))
    assert citations(docs).count() == 600 and citations(docs).where("is_self_cit").count() > 0
    assert made == [1]
    citations(works(spark, 10)).count()
    assert made == [1, 1]


def test_wide_works_cite_as_others_do(spark, docs_of, monkeypatch):
    def work(i, authors, cited):
        return {"id": f"W{i}", "publication_year": 2000 + i, "authorships": [{"author": {"id": f"A{a}"}} for a in authors], "referenced_works": [f"W{c}" for c in cited]}

    docs = docs_of(
        "works", work(1, range(100), [2, 3, 4, 5, 99]), work(2, [50, 500], [1, 2, 4]), work(3, [700], [1]), work(4, range(90, 300), [1, 4, 3]), work(5, [], [1]),
        work(1, [700], [3]),  # delivered again, with another author
    )
    rows = sorted(map(tuple, citations(durable(docs)).collect()), key=str)
    monkeypatch.setattr(derived, "WIDE", 10**6)
    assert rows == sorted(map(tuple, citations(durable(docs)).collect()), key=str)
    selves = {(r[0], r[2], r[5]) for r in rows}
    assert (1, 2, True) in selves and (1, 3, False) in selves and (1, 3, True) in selves and (4, 1, True) in selves and (1, 5, False) in selves and (1, 99, None) in selves


def links_plainly(authorships):
    """T14 and T15 with dictionaries."""
    known, places, found = {}, [], {}
    for i, a in enumerate(authorships, 1):
        for t in a["raw_affiliation_strings"]:
            places.append((1, i, known.setdefault(t, len(known) + 1)))
    for a in authorships:
        def add(pairs):
            new = [(known[t], int(x[1:])) for t, x in pairs if t in known and int(x[1:]) not in found.get(known[t], [])]
            for n, x in dict.fromkeys(new):
                found.setdefault(n, []).append(x)
            return bool(new)

        texts = a["raw_affiliation_strings"]
        if not add([(f["raw_affiliation_string"], x) for f in a["affiliations"] for x in f["institution_ids"]]) and texts:
            add([(texts[min(i, len(texts) - 1)], s["id"]) for i, s in enumerate(a["institutions"])])
    return places, [(1, n, i, x) for n, xs in found.items() for i, x in enumerate(xs, 1)]


def test_a_work_with_thousands_of_authors(spark, docs_of):
    def authorships(n):
        made = []
        for i in range(n):
            texts = [f"Department {i % (n // 2)}, University {i * 7 % n}", f"Institute {i % (n // 3)}"]
            listed = [{"raw_affiliation_string": t, "institution_ids": [f"I{(i + k) % n}", f"I{i % 9}"]} for k, t in enumerate(texts)] if i % 3 else []
            made.append({"raw_affiliation_strings": texts, "affiliations": listed, "institutions": [{"id": f"I{i % n}"}, {"id": f"I{i * 5 % n}"}]})
        return made

    seconds = {}
    for n in (60, 66, 1250, 5000):
        docs = durable(docs_of("works", {"id": "W1", "authorships": authorships(n)}))
        began = time.time()
        places = sorted(map(tuple, build("work_author_affiliation", {"works": docs}, None).collect()))
        links = sorted(map(tuple, build("work_affiliation_institution", {"works": docs}, None).collect()))
        seconds[n] = time.time() - began
        wanted_places, wanted_links = links_plainly(authorships(n))
        assert places == sorted(wanted_places) and links == sorted(wanted_links)
    assert seconds[5000] < 60 and seconds[5000] < 10 * seconds[1250]
