"""Quality rules: fixed rules and gradient-boosted trees over document statistics.

``train`` fits the trees to labelled documents, ``verdict`` scores every text. Trees
are flattened into node arrays (feature, threshold, left, right, value) that numpy
walks for a whole batch at once. On chosen features the score may only fall as the
feature grows: a split against the direction is refused, and the values of the two
sides stay apart on either side of their middle all the way down.

Training takes at most ``sample`` labelled documents, those with the smallest hashes
of their id; that bound is the only one. Statistics cover whole texts.

Defined cases: null text has no words; a text without enough words or with too many
repeated ones fails the base rules and is not kept, whatever the trees say; a label
that is null is ignored, several labels of one id count by their mean (half and more is
good), labelled rows that repeat an id count once each; without labels every text that
passes the base rules is kept; other columns are untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.llm.words import windows, word_hashes

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word_chars", "symbols_per_word", "capitals_per_char", "digits_per_char", "marks_per_word",
    "dup_lines_per_line", "repeated_share", "distinct_share", "words_per_line",
)
#: Features on which the score may only fall.
FALLING = ("symbols_per_word", "dup_lines_per_line", "repeated_share")
_SPACES, _SYMBOLS, _MARKS = [32, *range(9, 14)], list(b"#*$%&|<>"), list(b"!?")


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that the text holds twice or more."""
    found = windows(word_hashes(words), size)
    order = np.argsort(found, kind="stable")
    same = found[order[1:]] == found[order[:-1]]
    if not same.any():
        return 0
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def statistics(text: str | None) -> tuple[float, ...]:
    """The base statistics, then the features, of one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(len(raw) - counts[0x80:0xC0].sum() - counts[_SPACES].sum())
    symbols, n = int(counts[_SYMBOLS].sum()), len(words)
    seen: set[bytes] = set()
    lines = repeated_lines = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            repeated_lines += line in seen
            seen.add(line)
    repeated = repeated_words(words)
    per_word, per_char, per_line = max(n, 1), max(chars, 1), max(lines, 1)
    return (
        n, chars, symbols, repeated_lines, repeated,
        float(np.log1p(n)), chars / per_word, symbols / per_word, int(counts[65:91].sum()) / per_char, int(counts[48:58].sum()) / per_char,
        int(counts[_MARKS].sum()) / per_word, repeated_lines / per_line, repeated / per_word, len(set(words)) / per_word, n / per_line,
    )


def table_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=[*BASE, *FEATURES])


@dataclass(frozen=True)
class Trees:
    """All trees in one set of node arrays; a leaf is its own child."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality for each row of features."""
        rows, total = np.arange(len(x)), np.full(len(x), self.start)
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total


def fit(
    x: np.ndarray, good: np.ndarray, directions: np.ndarray, *, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48,
    ridge: float = 2.0, least: int = 5,
) -> Trees:
    """Boost the logistic loss. ``directions``: -1, 0 or 1 for each feature."""
    start = float(np.log((good.sum() + 1) / (len(good) - good.sum() + 1)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(good):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(len(good), start)

    def best_split(rows, gradient, hessian, low, high):
        g_all, h_all = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, None)
        for f, cut in enumerate(cuts):
            if not len(cut):
                continue
            of = binned[rows, f]
            g, h, n = (np.bincount(of, w, len(cut) + 1).cumsum()[:-1] for w in (gradient[rows], hessian[rows], None))
            left, right = (np.clip(-a / (b + ridge), low, high) for a, b in ((g, h), (g_all - g, h_all - h)))
            gain = -(g * left + 0.5 * (h + ridge) * left**2) - ((g_all - g) * right + 0.5 * (h_all - h + ridge) * right**2)
            own = np.clip(-g_all / (h_all + ridge), low, high)
            gain += g_all * own + 0.5 * (h_all + ridge) * own**2
            allowed = (n >= least) & (len(rows) - n >= least) & (directions[f] * (right - left) >= 0)
            gain = np.where(allowed, gain, -np.inf)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (f, i, left[i], right[i]))
        return best[1]

    def grow(rows, gradient, hessian, level, low, high):
        me = len(nodes)
        own = float(np.clip(-gradient[rows].sum() / (hessian[rows].sum() + ridge), low, high))
        nodes.append([0, np.inf, me, me, rate * own])
        split = best_split(rows, gradient, hessian, low, high) if level < depth and len(rows) >= 2 * least else None
        if split is None:
            score[rows] += rate * own
            return me
        f, i, left, right = split
        middle, goes = (left + right) / 2, binned[rows, f] <= i
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(directions[f])]
        children = [grow(part, gradient, hessian, level + 1, *b) for part, b in zip((rows[goes], rows[~goes]), bounds, strict=True)]
        nodes[me] = [f, cuts[f][i], *children, 0.0]
        return me

    for _ in range(trees if 0 < good.sum() < len(good) else 0):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(good)), p - good, p * (1 - p), 0, -np.inf, np.inf))
    flat = np.array(nodes, float).reshape(-1, 5)
    whole = [flat[:, i].astype(np.int64) for i in (0, 2, 3)]
    return Trees(start, np.array(roots, np.int64), whole[0], flat[:, 1], whole[1], whole[2], flat[:, 4], depth)


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Trees:
    """Fit to ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    pairs = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(table_of(texts)[list(FEATURES)].to_numpy(float).tolist())

    rows = pairs.select("doc_id", "good", features("text").alias("x")).orderBy("doc_id", "x").limit(4 * sample).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["good"].to_numpy(float), np.array([-1 if f in FALLING else 0 for f in FEATURES]))


def verdict(text: Column, model: Trees, least_words: int = 10, most_repeated: int = 20) -> Column:
    """A struct of the base statistics, ``base_failed``, ``score`` (the trees' probability
    of good quality) and ``kept``."""

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        found = table_of(texts)
        out = found[list(BASE)].astype("int64")
        out["base_failed"] = (out["n_words"] < least_words) | (100 * out["n_repeat_words"] > most_repeated * out["n_words"])
        out["score"] = 1 / (1 + np.exp(-model.score(found[list(FEATURES)].to_numpy(float))))
        out["kept"] = ~out["base_failed"] & (out["score"] >= 0.5)
        return out

    return judge(text)


def passing(docs: DataFrame, model: Trees, **how) -> DataFrame:
    """The rows of ``docs`` whose text is kept."""
    return docs.where(verdict(docs["text"], model, **how).getField("kept"))
