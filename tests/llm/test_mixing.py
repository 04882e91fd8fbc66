"""Fitted rates against the same descent in numpy, targets met, rows repeated as rated."""

import numpy as np
import pytest

from starfold.llm import mixing


def descent(tokens, p, wanted, ridge, most, steps=40, close=1e-5):
    whole, r = tokens.sum(), np.ones(len(tokens))
    share = np.maximum(tokens @ p / whole, 1e-6)
    reached = tokens @ p / whole
    for _ in range(steps):
        step = 1 / (1 + ridge)
        r = np.clip(r - step * (p @ ((reached - wanted) / share) + ridge * (r - 1)), 0, most)
        before, reached = reached, (tokens * r) @ p / whole
        if abs(reached - before).max() < close:
            break
    return r, reached


@pytest.mark.parametrize("most", [1.0, 4.0])
def test_rates_on_the_documents(spark, most):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = mixing.rated(docs, labels, most=most).toPandas()
    assert len(rows) == docs.count()
    tokens, p = rows[" tokens"].to_numpy(float), rows[[f" {d}" for d in mixing.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1)
    wanted = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    r, reached = descent(tokens, p, wanted / wanted.sum(), 1e-3, most)
    assert np.allclose(rows[" rate"], r, atol=1e-6)
    if most > 1:
        assert np.allclose(reached, wanted, atol=5e-3)
    assert ((rows[" copies"] == np.floor(r)) | (rows[" copies"] == np.floor(r) + 1)).all()


def test_posteriors_find_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = mixing.rated(docs.select("doc_id", "text"), labels.where("doc_id % 2 = 0")).toPandas()
    best = rows[[f" {d}" for d in mixing.DOMAINS]].to_numpy().argmax(axis=1)
    own = dict(zip([r["doc_id"] for r in rows[" row"]], best))
    other = labels.where("doc_id % 2 = 1").collect()
    right = [own[r.doc_id] == (2 if r.toxic else 1 - r.quality) for r in other]
    assert np.mean(right) > 0.95


def test_mixed_rows(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    copies = {r[" row"].doc_id: r[" copies"] for r in mixing.rated(docs, labels).collect()}
    mixed = mixing.mix(docs, labels)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: c for i, c in copies.items() if c}
    assert max(r["count"] for r in mixing.mix(docs, labels, most=1.0).groupBy("doc_id").count().collect()) == 1


def test_nulls_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (1, "a b", "x", 1), (1, "a b", "x", 1), (None, "", "x", 1)], "doc_id long, text string, tokens string, copies int")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = mixing.rated(docs, labels).collect()
    assert sorted(r[" tokens"] for r in rows) == [0, 0, 2, 2] and all(abs(r[" clean"] - 1 / 3) < 1e-9 for r in rows)
    assert mixing.mix(docs, labels).columns == docs.columns
    assert mixing.mix(docs.limit(0), labels.limit(0)).collect() == []


def test_native(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    plan = mixing.mix(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_few_labels_and_many_telling_words(spark):
    """Seven of sixty labelled documents tell by one word; in a larger sample, 120 words do."""
    def posteriors(texts, toxic):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        labels = spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
        rows = mixing.rated(docs, labels).collect()
        return {r[" row"].doc_id: r[" toxic"] for r in rows}

    few = posteriors([f"plain text w{i}" + (" scum" if i < 7 else "") for i in range(60)], [i < 7 for i in range(60)])
    assert min(few[i] for i in range(7)) > 0.9 and max(few[i] for i in range(7, 60)) < 0.1
    many = posteriors([f"plain text w{i}" + (f" bad{i % 120}" if i < 720 else "") for i in range(4000)], [i < 720 for i in range(4000)])
    assert min(many[i] for i in range(720)) > 0.9


def test_missed_targets_are_reported(spark):
    rows = spark.createDataFrame([(100, 0.7, 0.2, 0.1), (100, 0.9, 0.05, 0.05)], "tokens long, clean double, poor double, toxic double")
    with pytest.warns(UserWarning, match="toxic reaches"):
        rates = mixing.fit(rows, {"clean": 0.96, "poor": 0.03, "toxic": 0.01})
    assert set(rates.missed()) >= {"toxic"} and len(rates.reached) == 3
    half = spark.createDataFrame([(100, 1.0, 0.0, 0.0), (100, 0.0, 1.0, 0.0), (100, 0.0, 0.0, 1.0)], rows.schema)
    assert mixing.fit(half, {"clean": 0.96, "poor": 0.03, "toxic": 0.01}).missed() == {}


def test_kept_tokens_have_the_weights(spark):
    rows = spark.createDataFrame([(60, 1.0, 0.0, 0.0), (20, 0.0, 1.0, 0.0), (20, 0.0, 0.0, 1.0)], "tokens long, clean double, poor double, toxic double")
    for most, kept in ((1.0, 0.6 / 0.96), (4.0, 1.0)):
        reached = np.array(mixing.fit(rows, mixing.TARGETS, most=most, of_kept=True).reached)
        assert np.allclose(reached / reached.sum(), [mixing.TARGETS[d] for d in mixing.DOMAINS], atol=2e-3)
        assert abs(reached.sum() - kept) < 5e-3


def test_many_steps_are_one_small_expression(spark):
    """Forty steps give the rates of a plain loop, to the last bit, and one step's worth of plan."""
    pulls = tuple(tuple(float(x) for x in row) for row in np.random.default_rng(3).normal(0, 0.3, (40, 3)))
    posteriors = [(0.7, 0.2, 0.1), (0.0, 1.0, 0.0), (0.05, 0.05, 0.9)]
    rates = mixing.Rates(pulls, 1e-3, 1.5)
    rows = spark.createDataFrame(posteriors, "clean double, poor double, toxic double")

    def plain(p, r, since):
        step = 1 / (1 + rates.ridge)
        for a, b, c in pulls[since:]:
            r = min(max(r * (1 - step * rates.ridge) + step * rates.ridge - step * (p[0] * a + p[1] * b + p[2] * c), 0.0), rates.most)
        return r

    for start, since in (("1.0D", 0), ("0.5D", 33), ("0.5D", 40)):
        found = {(r.clean, r.poor): r.rate for r in rows.selectExpr("*", f"{rates.rate(list(mixing.DOMAINS), start, since)} as rate").collect()}
        assert found == {p[:2]: plain(p, float(start[:-1]), since) for p in posteriors}

    def size(k):
        several = mixing.Rates(pulls[:k], 1e-3, 1.5).rate(list(mixing.DOMAINS))
        return rows.selectExpr(several)._jdf.queryExecution().analyzed().expressions().apply(0).toString().count("least(")

    assert size(40) == size(2)
