"""Near-duplicate components against all pairs compared."""

import random

import pytest

from starfold.llm import minhash

DOCS = "doc_id long, text string, id long, component_id string"


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(rows):
    own = {}
    for i, t in rows:
        own[i] = shingles(t)
    parent = {i: i for i in own}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(own)
    for a in ids:
        for b in ids:
            both = len(own[a] & own[b])
            if a < b and own[a] and own[b] and 100 * both >= 75 * (len(own[a]) + len(own[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(own[i]), root(i), root(i) == i) for i in ids}


def found(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], DOCS).repartition(3)
    return {tuple(r) for r in minhash.near_duplicates(docs, **how).collect()}


def corpus(seed, n=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    base = draw.choices(vocabulary, k=90)
    rows = []
    for _ in range(n):  # one group of near copies at all distances, most of them linked only through others
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(90)] = draw.choice(vocabulary)
        rows.append(" ".join(words))
    passage = " ".join(draw.choices(vocabulary, k=50))
    rows += [passage + " " + " ".join(draw.choices(vocabulary, k=50)) for _ in range(20)]  # a shared passage, no links
    rows += [rows[0], rows[0].upper(), "too few", "too  few", "TOO\tfew", "too many", None, "", " \n"]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("star", [False, True])
def test_same_as_all_pairs(spark, star, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(minhash.links_between, "__defaults__", (8,))  # many blocks per bucket
    assert found(spark, rows, star=star) == plain(rows)


def test_without_stars_links_cross_blocks(spark):
    rows = corpus(8, 40)
    assert found(spark, rows, star=False) == plain(rows)


def test_repeats_nulls_and_empty(spark):
    text = "one two three four five six seven"
    rows = [(4, text), (4, text), (2, text), (None, text), (9, None), (9, "now some text that counts more than null")]
    assert found(spark, rows) == {(4, 3, 2, False), (2, 3, 2, True), (None, 3, None, True), (9, 4, 9, True)}
    assert found(spark, []) == set()
    assert found(spark, [(1, None), (2, "")]) == {(1, 0, 1, True), (2, 0, 2, True)}


def test_one_document_of_a_group_stays(spark):
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words stand here now"), (5, None)]
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], DOCS)
    out = minhash.without_near_duplicates(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 2, 5}


def test_bounds_hold_the_miss_probability():
    for n, fewest in minhash.bounds(128, 16, 0.75, 1e-4):
        assert 0 < fewest < 0.75 * n
