"""Base statistics against plain counts; trees against their constraints and held-out labels."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from starfold.llm import quality_rules as q
from starfold.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    for s in SPACES:
        text = text.replace(s, " ")
    return [w for w in text.split(" ") if w]


def plain(text):
    text = text or ""
    own = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [
    None, "", " \n\t", "a", "a b c d e a b c d e", "x " * 400, "a b\na b\n\n\na b ", "ünï # * $ % & | < > a b c", "a b c d e f a b c d e", "l\r\nl\r\nl",
    " ".join(str(i % 7) for i in range(60)),
]


def test_base_statistics():
    for text in TEXTS:
        assert q.statistics(text)[:5] == plain(text)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_quality_rules"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r.base_failed and r.kept)


def test_agrees_with_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = q.train(docs, labels.where("doc_id % 2 = 0"))
    other = docs.join(labels.where("doc_id % 2 = 1").select("doc_id", "quality"), "doc_id").select("quality", q.verdict(F.col("text"), model).alias("v")).collect()
    right = [(r.v.score >= 0.5) == (r.quality == 1) for r in other]
    assert np.mean(right) > 0.95


def test_trees_are_monotonic_and_flat():
    draw = np.random.default_rng(2)
    x = draw.uniform(size=(2000, 3))
    good = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 0]) + draw.normal(0, 0.2, 2000)) < 0.6).astype(float)
    model = q.fit(x, good, np.array([-1, 0, 0]))
    grid = np.tile([0.0, 0.5, 0.5], (200, 1))
    grid[:, 0] = np.linspace(0, 1, 200)
    for other in draw.uniform(size=(20, 2)):
        grid[:, 1:] = other
        assert (np.diff(model.score(grid)) <= 1e-12).all()
    assert (((model.score(x) > 0) == (good == 1)).mean()) > 0.8
    free = q.fit(x, good, np.array([0, 0, 0]))
    grid[:, 1:] = 0.5
    assert (np.diff(free.score(grid)) > 0).any()

    def walk(tree, row):
        at = tree
        while model.left[at] != at:
            at = model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at]
        return model.value[at]

    for row in x[:20]:
        assert np.isclose(model.score(row[None])[0], model.start + sum(walk(t, row) for t in model.roots))


def test_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "word " * 3, 5), (1, " ".join(f"w{random.randint(0, 10**9)}" for _ in range(30)), 5), (None, None, 5)], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = q.passing(docs, q.train(docs, labels))
    assert out.columns == docs.columns and [r.text[0] for r in out.collect()] == ["w"] and out.count() == 1
    assert q.passing(docs.limit(0), q.train(docs.limit(0), labels.limit(0))).collect() == []
