"""Mixing documents to target weights of soft domains, with DataFrame functions only.

A labelled table defines the domains; a smoothed naive Bayes classifier over all telling
words and marks, by their presence and absence, predicts the posterior of each domain for
every document. A feature is telling if chance does not explain how often it occurs in a
domain; the bound on that chance holds for samples of any size, and the share of false
ones among those found is held at ``false``, whatever the vocabulary. Their number is not
bounded: their weights are a table, broadcast only when its measured bytes are small.
Rates r >= 0 per document are then fitted so that the expected tokens of each domain,
sum(r * tokens * posterior), meet the targets: projected gradient descent on

    sum over domains of (share reached - target)^2 / natural share
    + ridge * sum over documents of (its share of tokens) * (r - 1)^2.

The gradient of a document depends on its posteriors and on one residual per domain,
so a step is an aggregate of as many sums as there are domains, and the rate after any
number of steps is a function of the posteriors and of the residuals so far: no state
per document is shuffled or joined, and the fitted rates are applied in a plain scan.

The classifier is fitted to at most ``sample`` labelled documents, those with the
smallest hashes of their id; that is the only bound. Posteriors and totals cover all
documents and whole texts.

Defined cases: null text has no tokens and no features; labels that are null are
ignored, and of several for one id toxic wins over poor over clean; without labels the
posteriors are equal; rows that repeat an id are rated each, and alike; a null id is
rated like any other; extra columns are kept, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators.joins import known_small, text_bytes
from starfold.session import durable

DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.96, "poor": 0.03, "toxic": 0.01}
#: What separates words: blanks, and marks that cling to them.
_BETWEEN = " \t\n\x0b\x0c\r.,;:!?\"()*#%&$|<>"


def words_of(text: Column) -> Column:
    """Words of a text in lower case, without marks; the empty list for null."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_BETWEEN))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_BETWEEN}]+"))


def marks_of(text: Column, words: Column, distinct: Column) -> Column:
    """Marks that stand beside the words as features; the blank in them keeps them apart."""
    text = F.coalesce(text, F.lit(""))
    marks = {
        " symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")) * 10 > F.size(words),
        " capitals": F.regexp_count(text, F.lit("[A-Z]")) * 4 > F.length(text),
        " repeats": (F.size(words) >= 30) & (F.size(distinct) * 3 < F.size(words)),
    }
    return F.filter(F.array(*[F.when(found, F.lit(name)) for name, found in marks.items()]), lambda m: m.isNotNull())


def described(docs: DataFrame) -> DataFrame:
    """``tokens`` and ``features`` (distinct words and marks) beside the columns of ``docs``;
    both are named so that no column of a table can clash."""
    names = docs.columns
    cut = docs.select(F.struct(*names).alias(" row"), words_of(F.col("text")).alias(" words"))
    cut = cut.select(" row", " words", F.array_distinct(" words").alias(" distinct"))
    return cut.select(
        " row", F.size(" words").cast("long").alias(" tokens"),
        F.concat(" distinct", marks_of(F.col(" row").getField("text"), F.col(" words"), F.col(" distinct"))).alias(" features"),
    )


#: Stands for the document itself among its features; the blank keeps it apart from words.
_SELF = " self"
_WEIGHTS = [f"w_{d}" for d in DOMAINS]
#: Scores are counted in steps of one over this, up to the last step.
_STEPS, _LAST = 2, 1200


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over the telling features: what a document without any has as log
    probability of each domain, and a table of ``feature`` and what it adds to each."""

    bias: tuple[float, ...]
    weights: DataFrame

    def scored(self, docs: DataFrame, seed: int) -> DataFrame:
        """A row for every distinct id and text of ``docs`` (doc_id, text), named by `` id``
        and two hashes of the text: how many `` rows`` it has, `` tokens``, `` draw`` (uniform,
        from a hash of id and text) and the posterior of each domain."""
        draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        cut = described(docs.select("doc_id", "text", draw.alias("draw")))
        row = F.col(" row")
        keyed = cut.select(
            row.getField("doc_id").alias(" id"), *[h.alias(n) for n, h in _hashes(row.getField("text")).items()], " tokens", row.getField("draw").alias(" draw"),
            F.explode(F.concat(" features", F.array(F.lit(_SELF)))).alias("feature"),
        )
        own = self.weights.sparkSession.createDataFrame([(_SELF, *self.bias)], self.weights.schema)
        table = self.weights.unionByName(own)
        if text_bytes(table, "feature") <= known_small(table.sparkSession):
            table = F.broadcast(table)
        sums = keyed.join(table, "feature").groupBy(*_KEY).agg(
            F.sum((F.col("feature") == _SELF).cast("long")).alias(" rows"), F.first(" tokens").alias(" tokens"), F.first(" draw").alias(" draw"),
            *[F.sum(w).alias(w) for w in _WEIGHTS],
        )
        logs = F.array(*[F.col(w) / F.col(" rows") for w in _WEIGHTS])
        return sums.select(*_KEY, " rows", " tokens", " draw", *[p.alias(f" {d}") for d, p in zip(DOMAINS, softmax(logs), strict=True)])


_KEY = [" id", " h1", " h2"]


def _hashes(text: Column) -> dict[str, Column]:
    return {" h1": F.xxhash64(text), " h2": F.xxhash64(F.lit(1), text)}


def _surprise(own: Column, have: Column, share: float) -> Column:
    """Chernoff's bound, as -log, on the chance that ``own`` or more of the ``have``
    documents with a feature are of a domain with that share of the sample."""
    rest = have - own

    def part(n: Column, p: float) -> Column:
        return F.when(n > 0, n * F.log(n / (have * p))).otherwise(0.0)

    return F.when(own > have * share, part(own, share) + part(rest, 1 - share)).otherwise(0.0)


def _threshold(held: DataFrame, score: Column, reach: Column, false: float) -> float | None:
    """The least score at which the features that chance would bring so far are at most
    ``false`` of those found. Only those count as brought by chance that could reach the
    score at all, were they in no other domain."""
    counts = []
    for value in (score, reach):
        step = F.least(F.floor(value * _STEPS), F.lit(_LAST)).cast("int").alias("step")
        own = [0] * (_LAST + 1)
        for r in held.groupBy(step).agg(F.count("*").alias("n")).collect():
            own[r["step"]] = r["n"]
        counts.append([sum(own[t:]) for t in range(_LAST + 1)])
    return next((t / _STEPS for t, (found, able) in enumerate(zip(*counts, strict=True)) if found and able * exp(-t / _STEPS) <= false * found), None)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, false: float = 0.1, smooth: float = 0.1) -> Classifier:
    """Naive Bayes on every feature that tells of a domain other than the first, ``smooth``
    added to the documents with and without it."""
    label = F.when(F.max("toxic") == 1, 2).when(F.min("quality") == 0, 1).when(F.max("quality") == 1, 0)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(label.alias("domain")).where("domain is not null")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = durable(described(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("domain", "text")).select(
        F.col(" row").getField("domain").alias("domain"), F.col(" features").alias("features")
    ))
    sizes = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = [sizes.get(k, 0) for k in range(len(DOMAINS))]
    total = sum(n)
    held = durable(rows.select("domain", F.explode("features").alias("feature")).groupBy("feature").agg(
        *[F.sum((F.col("domain") == k).cast("int")).alias(d) for k, d in enumerate(DOMAINS)]
    ))
    have = sum((F.col(d) for d in DOMAINS[1:]), F.col(DOMAINS[0]))
    telling = F.lit(False)
    for k, d in enumerate(DOMAINS):
        if k and 0 < n[k] < total:
            score = _surprise(F.col(d), have, n[k] / total)
            least = _threshold(held, score, have * -log(n[k] / total), false)
            telling = telling if least is None else telling | (score >= least)
    with_it = [(F.col(d) + smooth) / (n[k] + 2 * smooth) for k, d in enumerate(DOMAINS)]
    weights = durable(held.where(telling).select(
        "feature", *[F.log(p / (1 - p)).alias(w) for p, w in zip(with_it, _WEIGHTS, strict=True)], *[F.log(1 - p).alias(d) for p, d in zip(with_it, DOMAINS, strict=True)],
    ))
    absent = weights.agg(*[F.coalesce(F.sum(d), F.lit(0.0)) for d in DOMAINS]).first()
    bias = tuple(log((m + 1) / (total + len(DOMAINS))) + b for m, b in zip(n, absent, strict=True))
    return Classifier(bias, weights.select("feature", *_WEIGHTS))


def softmax(logs: Column) -> list[Column]:
    """Probabilities from an array of logs, as columns."""
    top = F.array_max(logs)
    parts = [F.exp(F.get(logs, F.lit(k)) - top) for k in range(len(DOMAINS))]
    return [p / sum(parts[1:], parts[0]) for p in parts]


@dataclass(frozen=True)
class Rates:
    """What the descent has gathered: per step, the pull of each domain; and the tokens
    of each domain, in shares of all that came in, as they were wanted and are reached."""

    pulls: tuple[tuple[float, ...], ...]
    ridge: float
    most: float
    wanted: tuple[float, ...] = ()
    reached: tuple[float, ...] = ()

    def missed(self, by: float = 5e-3) -> dict[str, tuple[float, float]]:
        """Wanted and reached of the domains that are off by more than ``by``."""
        return {d: (w, r) for d, w, r in zip(DOMAINS, self.wanted, self.reached) if abs(w - r) > by}

    def rate(self, posteriors: list[str], start: str = "1.0D", since: int = 0) -> str:
        """The rate as SQL over the names of the posteriors, from ``start`` after ``since`` steps.
        The steps are a fold over a list of their pulls: plan and code stay as small after many
        steps as after one, and steps share their code."""
        step, pulls = 1 / (1 + self.ridge), self.pulls[since:]
        if not pulls:
            return start
        listed = ", ".join(f"array({', '.join(f'{c!r}D' for c in pull)})" for pull in pulls)
        along = " + ".join(f"`{p}` * pull[{k}]" for k, p in enumerate(posteriors))
        one = f"least(greatest(so_far * {1 - step * self.ridge!r}D + {step * self.ridge!r}D - {step!r}D * ({along}), 0.0D), {float(self.most)!r}D)"
        return f"aggregate(array({listed}), {start}, (so_far, pull) -> {one})"


def fit(rows: DataFrame, targets: dict[str, float], ridge: float = 1e-3, most: float = 4.0, steps: int = 40, close: float = 1e-5, keep: int = 8, of_kept: bool = False) -> Rates:
    """Rates for ``rows`` (tokens and one posterior column per domain) by projected
    gradient descent; every step is one aggregate over narrow rows, which are written
    down with their rates after every ``keep`` steps. The targets are shares of the tokens
    that come in or, with ``of_kept``, of those that are kept: if a domain cannot reach its
    share of all tokens at the highest rate, all targets shrink alike until it can."""
    tokens = F.col("tokens").cast("double")
    weight = sum(targets.values())
    wanted = [targets[d] / weight for d in DOMAINS]
    whole, *natural = rows.agg(F.sum(tokens), *[F.sum(tokens * F.col(d)) for d in DOMAINS]).first()
    if not whole:
        return Rates((), ridge, most)
    if of_kept:
        total = min([1.0, *[most * v / whole / w for v, w in zip(natural, wanted, strict=True) if w]])
        wanted = [w * total for w in wanted]
    scale = [max(v / whole, 1e-6) for v in natural]
    reached, pulls = [v / whole for v in natural], []
    rows = rows.withColumn("rate", F.lit(1.0))
    for step in range(1, steps + 1):
        pulls.append(tuple((have - want) / s for have, want, s in zip(reached, wanted, scale, strict=True)))
        rate = F.expr(Rates(tuple(pulls), ridge, most).rate(list(DOMAINS), "rate", (step - 1) // keep * keep))
        if step % keep == 0:
            rows, rate = durable(rows.withColumn("rate", rate)), F.col("rate")
        before, reached = reached, [v / whole for v in rows.select("tokens", *DOMAINS, rate.alias("rate")).agg(*[F.sum(tokens * F.col("rate") * F.col(d)) for d in DOMAINS]).first()]
        if max(abs(a - b) for a, b in zip(reached, before, strict=True)) < close:
            break
    rates = Rates(tuple(pulls), ridge, most, tuple(wanted), tuple(reached))
    for domain, (want, have) in rates.missed().items():
        warnings.warn(f"mixing: {domain} reaches {have:.4f} of the tokens instead of {want:.4f}", stacklevel=2)
    return rates


def _with_copies(scored: DataFrame, rates: Rates) -> DataFrame:
    """`` rate`` and `` copies``: the whole part of the rate, and one more with the chance
    of the rest."""
    out = scored.withColumn(" rate", F.expr(rates.rate([f" {d}" for d in DOMAINS])))
    more = (F.col(" draw") < F.col(" rate") - F.floor(" rate")).cast("long")
    return out.withColumn(" copies", F.floor(" rate") + more)


def _fitted(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None, sample: int, most: float, seed: int, of_kept: bool) -> DataFrame:
    """A row for every distinct id and text, with its rate and copies."""
    narrow = durable(train(docs, labels, sample).scored(docs, seed))
    rows = narrow.select((F.col(" tokens") * F.col(" rows")).alias("tokens"), *[F.col(f" {d}").alias(d) for d in DOMAINS])
    return _with_copies(narrow, fit(rows, targets or TARGETS, most=most, of_kept=of_kept))


def rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, *, sample: int = 20_000, most: float = 4.0, seed: int = 17, of_kept: bool = False) -> DataFrame:
    """`` row`` (with doc_id), `` tokens``, the posterior of each domain (its name after a
    blank), `` rate`` and `` copies`` of every row of ``docs``."""
    every = _fitted(docs, labels, targets, sample, most, seed, of_kept).withColumn(" row", F.explode(F.array_repeat(F.struct(F.col(" id").alias("doc_id")), F.col(" rows").cast("int"))))
    return every.select(" row", " tokens", " draw", *[f" {d}" for d in DOMAINS], " rate", " copies")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, *, sample: int = 20_000, most: float = 4.0, seed: int = 17, of_kept: bool = False) -> DataFrame:
    """``docs`` with every row as often as its rate says; never more than once with ``most`` = 1."""
    copies = _fitted(docs, labels, targets, sample, most, seed, of_kept).where(F.col(" copies") > 0).select(*_KEY, F.array_repeat(F.lit(True), F.col(" copies").cast("int")).alias(" copies"))
    rows = docs.select(F.struct(*docs.columns).alias(" row"), F.col("doc_id").alias(" own"), *[h.alias(f"{n} own") for n, h in _hashes(F.col("text")).items()])
    on = F.col(" own").eqNullSafe(F.col(" id")) & (F.col(" h1 own") == F.col(" h1")) & (F.col(" h2 own") == F.col(" h2"))
    out = rows.join(copies, on).select(" row", F.explode(" copies"))
    return out.select(*[F.col(" row").getField(c).alias(c) for c in docs.columns])
