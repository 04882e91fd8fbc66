"""The shrunken rates against plain numpy, and accuracy on labels not seen."""

import numpy as np
import pytest

from starfold.llm import site_quality as sq


def test_accuracy_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = sq.train(docs, labels.where("doc_id % 2 = 0"))
    kept = {r.doc_id: r.kept for r in sq.classify(docs, model).collect()}
    other = labels.where("doc_id % 2 = 1").collect()
    assert len(kept) == docs.count()
    assert np.mean([kept[r.doc_id] == (r.quality == 1) for r in other]) > 0.95


def strength(n, good, mean):
    off = (n * (good / n - mean) ** 2).sum()
    noise = (n * mean * (1 - mean)).sum() / n.sum()
    free = n.sum() - (n * n).sum() / n.sum()
    if free <= 0:
        return 1.0
    spread = (off - (len(n) - 1) * noise) / free
    return min(max(noise / max(spread, noise * 1e-6 + 1e-12) - 1, 1.0), 1e6)


def test_rates_and_posteriors(spark):
    rows = [(i, f"text {i} " + ("good " * (i % 7) if i % 3 else "bad "), ["a", "b", None][i % 3] if i < 50 else "c", f"p{i % 4}" if i % 5 else None) for i in range(60)]
    rows += [(60, None, "sparse", "only"), (60, None, "sparse", "only"), (None, "", None, None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, source string, lang string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(1, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    model = sq.train(docs, labels)
    found = sq.classify(docs, model).collect()
    assert len(found) == len(rows)
    logit = np.array([model.logit(r[1]) for r in rows])
    p = 1 / (1 + np.exp(-logit))
    prior = p.mean()
    hosts, paths = [r[2] for r in rows], [(r[2], r[3]) for r in rows]

    def sums(keys):
        return {k: (sum(x == k for x in keys), sum(v for x, v in zip(keys, p) if x == k)) for k in set(keys)}

    of_host, of_path = sums(hosts), sums(paths)
    k0 = strength(*(np.array([v[i] for v in of_host.values()], float) for i in (0, 1)), prior)
    rate = {h: (k0 * prior + g) / (k0 + n) for h, (n, g) in of_host.items()}
    names = list(of_path)
    k1 = strength(*(np.array([of_path[k][i] for k in names], float) for i in (0, 1)), np.array([rate[k[0]] for k in names]))
    expected = []
    for (i, _, h, q), own, x in zip(rows, p, logit):
        n, g = of_path[h, q]
        without = (k1 * rate[h] + g - own) / (k1 + n - 1)
        expected.append((i if i is not None else -1, rate[h], 1 / (1 + np.exp(-(x + np.log(without / (1 - without)) - np.log(prior / (1 - prior)))))))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.host_rate, r.score) for r in found)
    for a, b in zip(got, sorted(expected)):
        assert a == pytest.approx(b, rel=1e-9)
    by = {r.doc_id: r for r in found}
    assert abs(by[60].path_rate - prior) < abs(p[60] - prior)  # a sparse site stays near the prior


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words", "s", "en")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = sq.train(docs, labels)
    assert [r.kept for r in sq.classify(docs, model).collect()] == [True]
    assert sq.classify(docs.limit(0), model).collect() == []
