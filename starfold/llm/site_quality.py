"""Quality classifier that shrinks sites: document evidence with host and path priors.

A logistic regression over hashed words and text statistics gives each document's own
odds of good quality. Grouped sums of these probabilities over hosts, and over paths
within hosts, are shrunk in two steps (empirical Bayes): a host's rate towards the
global one, a path's towards its host's, each with the strength that the spread between
the groups calls for (method of moments), so a sparse site stays near the prior above
it. A document's posterior odds are its own odds with the global prior replaced by the
prior of its path, from which the document itself has been taken out.

The regression is fitted to at most ``sample`` labelled documents, those with the
smallest hashes of their id; that is the only bound. All rates cover all documents.

Defined cases: null text is empty; a null host or path is a group of its own; labels
that are null are ignored, several of one id count by their mean; without labels of
both kinds every document's own odds are the smoothed share of good labels; rows that
repeat an id are judged each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.quality_rules import BASE, FEATURES, statistics
from starfold.llm.words import word_hashes, words_of
from starfold.session import durable

BUCKETS = 1 << 14


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and the statistics."""
    hashes = np.unique(word_hashes(list(set(words_of(text, lower=True)))) % np.uint64(BUCKETS))
    return hashes.astype(np.int32), np.array(statistics(text)[len(BASE):])


class Model:
    """Weights of word buckets and of standardised statistics."""

    def __init__(self, bias: float, words: np.ndarray, centre: np.ndarray, scale: np.ndarray, numbers: np.ndarray):
        self.bias, self.words, self.centre, self.scale, self.numbers = bias, words, centre, scale, numbers

    def logit(self, text: str | None) -> float:
        found, numbers = features(text)
        own = self.words[found].sum() / np.sqrt(max(len(found), 1))
        return float(np.clip(self.bias + own + np.clip((numbers - self.centre) / self.scale, -5, 5) @ self.numbers, -12, 12))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 200, rate: float = 0.3, ridge: float = 1e-4) -> Model:
    """Logistic regression by adaptive gradient steps over all rows at once."""
    good = np.array([g for *_, g in rows], float)
    width = len(FEATURES)
    bias, words, numbers = float(np.log((good.sum() + 1) / (len(good) - good.sum() + 1))), np.zeros(BUCKETS), np.zeros(width)
    if not 0 < good.sum() < len(good):
        return Model(bias, words, np.zeros(width), np.ones(width), numbers)
    x = np.array([n for _, n, _ in rows])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.clip((x - centre) / scale, -5, 5)
    owner = np.repeat(np.arange(len(rows)), [len(w) for w, *_ in rows])
    bucket = np.concatenate([w for w, *_ in rows])
    value = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=len(rows)), 1))[owner]
    squares = [1e-8, np.full(BUCKETS, 1e-8), np.full(width, 1e-8)]
    for _ in range(rounds):
        logit = bias + np.bincount(owner, words[bucket] * value, len(rows)) + x @ numbers
        miss = (1 / (1 + np.exp(-logit)) - good) / len(rows)
        steps = [miss.sum(), np.bincount(bucket, miss[owner] * value, BUCKETS) + ridge * words, x.T @ miss + ridge * numbers]
        squares = [s + g * g for s, g in zip(squares, steps, strict=True)]
        bias, words, numbers = (v - rate * g / np.sqrt(s) for v, g, s in zip((bias, words, numbers), steps, squares, strict=True))
    return Model(bias, words, centre, scale, numbers)


def train(docs: DataFrame, labels: DataFrame, sample: int = 5_000) -> Model:
    """Fit to ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*features(t), g) for t, g in zip(batch["text"], batch["good"], strict=True)]
            yield pd.DataFrame([(w.tobytes(), n.tobytes(), g) for w, n, g in rows], columns=["words", "numbers", "good"])

    pairs = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInPandas(described, "words binary, numbers binary, good int")
    rows = pairs.orderBy("numbers", "words", "good").limit(2 * sample).collect()
    return fit([(np.frombuffer(r.words, np.int32), np.frombuffer(r.numbers), r.good) for r in rows])


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(spread: Column, noise: Column) -> Column:
    """Prior observations from the variance between groups beyond their noise."""
    return F.least(F.greatest(F.coalesce(noise / F.greatest(spread, noise * 1e-6 + 1e-12) - 1, F.lit(1.0)), F.lit(1.0)), F.lit(1e6))


def _moments(groups: DataFrame, mean: Column) -> Column:
    """Strength of the prior ``mean`` over groups with ``n`` and ``good``."""
    off = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - mean, 2))
    noise = F.sum(F.col("n") * mean * (1 - mean)) / F.sum("n")
    free = F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")
    spread = F.when(free > 0, (off - (F.count("*") - 1) * noise) / free)
    return groups.agg(_strength(spread, noise).alias("k")).first()["k"] or 1.0


def classify(docs: DataFrame, model: Model, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, host, path, evidence (the document's own log odds), host_rate, path_rate,
    score (posterior probability) and kept for every row of ``docs``."""

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series([model.logit(t) for t in texts], dtype=float)

    judged = durable(docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), evidence("text").alias("evidence")))
    judged = judged.withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))
    paths = judged.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("p").alias("good"))
    paths = durable(paths)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    prior = F.lit(min(max(total, 1e-6), 1 - 1e-6) if total is not None else 0.5)
    strength = _moments(hosts, prior)
    rates = hosts.select(F.col("host").alias("h"), ((prior * strength + F.col("good")) / (strength + F.col("n"))).alias("host_rate"))
    nested = durable(paths.join(rates, F.col("host").eqNullSafe(F.col("h"))).select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "good", "host_rate"))
    inner = _moments(nested, F.col("host_rate"))
    on = F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q"))
    without = (inner * F.col("host_rate") + F.col("good") - F.col("p")) / (inner + F.col("n") - 1)
    posterior = F.col("evidence") + _logit(F.least(F.greatest(without, F.lit(1e-6)), F.lit(1 - 1e-6))) - _logit(prior)
    return judged.join(nested, on).select(
        "doc_id", "host", "path", "evidence", "host_rate", ((inner * F.col("host_rate") + F.col("good")) / (inner + F.col("n"))).alias("path_rate"),
        (1 / (1 + F.exp(-posterior))).alias("score"), (posterior >= 0).alias("kept"),
    )
