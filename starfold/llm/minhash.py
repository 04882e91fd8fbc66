"""Near-duplicates by banded MinHash with sequential Bayesian verification.

1. Every text becomes the set of its word shingles; texts with equal sets are one class
   from here on, named by its smallest document id, so copies cost nothing more.
2. Each class has a signature of ``bands * rows`` minimum hashes. Classes that agree on
   a whole band share a bucket.
3. Links are sought where they can still matter. Every member of a bucket is compared
   with its smallest; those linked to the same one form a component so far. Buckets that
   still hold several components go on: every two members that lie in different ones are
   compared, inside blocks of bounded size that give out nothing but links, so no link
   that could join two components is missed and no table of pairs is formed.
4. A pair is compared batch by batch of its signatures: after each batch the posterior
   of the similarity (uniform prior) says how likely it is to reach the threshold, and
   the pair is dropped below ``miss``. Survivors are verified on the full shingle sets.

A pair of similarity s shares a bucket with probability 1 - (1 - s^rows)^bands: at the
threshold 0.75 that is 0.999995 for 32 bands of 4 rows.

Defined cases: null or empty text has no shingles and links with nothing; a text with
fewer words than a shingle is one shingle; rows that repeat an id count once, the one
with the largest set deciding if their texts differ; a row without an id is returned with
neither component nor shingle links and is kept; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.components import components
from starfold.llm.words import shingles, words_of
from starfold.session import durable

SHINGLE, BANDS, ROWS = 5, 32, 4
_DRAW = np.random.default_rng(11)
_A = _DRAW.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _DRAW.integers(0, 2**63, 1024, dtype=np.uint64)


def signature(found: np.ndarray, hashes: int, step: int = 2048) -> np.ndarray:
    """Minimum of each of ``hashes`` 32-bit hash functions over a shingle set."""
    a, b, least = _A[:hashes, None], _B[:hashes, None], np.full(hashes, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(found), step):
        np.minimum(least, ((a * found[i:i + step] + b) >> np.uint64(32)).min(axis=1), out=least)
    return least.astype(np.uint32)


def bounds(hashes: int, batch: int, similarity: float, miss: float) -> list[tuple[int, int]]:
    """(hashes seen, fewest matches) below which the posterior chance of reaching
    ``similarity`` is under ``miss``: the tail of Beta(1 + matches, 1 + mismatches)."""
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, 0  # P(Beta(1+m, 1+n-m) > t) = P(Binomial(n+1, t) <= m)
        while m <= n:
            tail += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def described(docs: DataFrame, size: int, hashes: int) -> DataFrame:
    """doc_id, n_shingles, class (hash of the shingle set) and signature of each row."""

    @F.pandas_udf("n_shingles long, class binary, signature binary")
    def describe(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shingles(words_of(text, lower=True), size)
            rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), signature(found, hashes).tobytes() if len(found) else b""))
        return pd.DataFrame(rows, columns=["n_shingles", "class", "signature"])

    return docs.select("doc_id", describe("text").alias("d")).select("doc_id", "d.*")


def shingle_sets(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """id and shingle set (sorted 64-bit hashes) of the wanted ``classes`` (id, class)."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, kind, text in zip(batch["id"], batch["class"], batch["text"], strict=True):
                raw = shingles(words_of(text, lower=True), size).tobytes()
                if xxhash.xxh3_128_digest(raw) == bytes(kind):
                    out.append((i, raw))
            yield pd.DataFrame(out, columns=["id", "shingles"])

    texts = docs.select(F.col("doc_id").alias("id"), "text").join(classes, "id")
    return texts.mapInPandas(sets, "id long, shingles binary").groupBy("id").agg(F.any_value("shingles").alias("shingles"))


def _blocks(members: DataFrame, chunk: int) -> DataFrame:
    """``members`` (bucket, band, id, component) dealt out to blocks: each bucket is cut
    into chunks of about ``chunk`` members, large components into chunks of their own, and
    any two chunks meet in a block unless all their members are of one component."""
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n")).withColumn("large", F.col("n") > chunk)
    rest = sizes.where("not large").groupBy("bucket").agg(F.sum("n").alias("rest"))
    share = F.ceil(F.when(F.col("large"), F.col("n")).otherwise(F.col("rest")) / chunk)
    cut = members.join(sizes, ["bucket", "component"]).join(rest, "bucket", "left").select(
        "bucket", "band", "id", "component",
        F.struct(F.col("large"), F.when(F.col("large"), F.col("component")).alias("of"), F.pmod(F.xxhash64("id"), share).alias("part")).alias("chunk"),
    )
    chunks = cut.select("bucket", "chunk").distinct()
    meet = chunks.join(chunks.withColumnRenamed("chunk", "other"), "bucket").where("chunk <= other and not (chunk.large and other.large and chunk.of = other.of)")
    sides = F.when(F.col("chunk") == F.col("other"), F.array(F.struct(F.col("chunk"), F.lit(-1).alias("side")))).otherwise(
        F.array(F.struct(F.col("chunk"), F.lit(0).alias("side")), F.struct(F.col("other").alias("chunk"), F.lit(1).alias("side")))
    )
    places = meet.select("bucket", F.xxhash64("bucket", "chunk", "other").alias("block"), F.explode(sides).alias("s")).select("bucket", "block", "s.*")
    return cut.join(places, ["bucket", "chunk"]).select("block", "side", "band", "id", "component")


def _linked_in(block: pd.DataFrame, hashes: int, rows: int, limits: list[tuple[int, int]], similarity: int) -> list[tuple[int, int]]:
    """Links between different components of one block, as many as it takes to join them."""
    ids, labels, band = block["id"].to_numpy(), block["component"].to_numpy().copy(), int(block["band"].iloc[0])
    one = block["side"].iloc[0] == -1
    signs = np.frombuffer(b"".join(block["signature"]), np.uint32).reshape(-1, hashes)
    sets = [np.frombuffer(x, np.uint64) for x in block["shingles"]]
    sizes = np.array([len(x) for x in sets])
    right = np.arange(len(ids)) if one else np.flatnonzero(block["side"].to_numpy() == 1)
    out = []
    for x in range(len(ids)) if one else np.flatnonzero(block["side"].to_numpy() == 0):
        ys = right[right > x] if one else right
        ys = ys[(labels[ys] != labels[x]) & (100 * np.minimum(sizes[ys], sizes[x]) >= similarity * np.maximum(sizes[ys], sizes[x]))]
        matches, seen = np.zeros(len(ys), np.int64), 0
        for n, fewest in limits:
            if not len(ys):
                break
            matches += (signs[ys, seen:n] == signs[x, seen:n]).sum(axis=1)
            ys, matches, seen = ys[matches >= fewest], matches[matches >= fewest], n
        if len(ys):  # a pair is compared in the first band it shares, nowhere else
            agree = (signs[ys] == signs[x]).reshape(len(ys), -1, rows).all(axis=2)
            ys = ys[agree.argmax(axis=1) == band]
        if len(ys):
            every = np.concatenate([sets[y] for y in ys])
            at = np.minimum(np.searchsorted(sets[x], every), sizes[x] - 1)
            both = np.add.reduceat((sets[x][at] == every).astype(np.int64), np.cumsum(sizes[ys]) - sizes[ys])
            for y in ys[100 * both >= similarity * (sizes[ys] + sizes[x] - both)]:
                if labels[y] != labels[x]:
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    labels[labels == labels[y]] = labels[x]
    return out


def links_between(members: DataFrame, sets: DataFrame, hashes: int, rows: int, limits: list[tuple[int, int]], similarity: int, chunk: int = 1024) -> DataFrame:
    """Links (a, b) that join the components of the buckets in ``members``. All pairs of
    different components are compared, inside blocks of bounded size; only links
    leave a block."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            edges = np.flatnonzero(np.diff(batch["block"].to_numpy())) + 1
            found = [link for part in np.split(np.arange(len(batch)), edges)[:-1] for link in _linked_in(batch.iloc[part], hashes, rows, limits, similarity)]
            rest = batch.iloc[edges[-1] if len(edges) else 0:]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if rest is not None and len(rest):
            yield pd.DataFrame(_linked_in(rest, hashes, rows, limits, similarity), columns=["a", "b"], dtype="int64")

    blocks = _blocks(members, chunk).join(sets.select("id", "signature", "shingles"), "id")
    return blocks.repartition("block").sortWithinPartitions("block", "side", "id").mapInPandas(compare, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, *, size: int = SHINGLE, similarity: int = 75, bands: int = BANDS, rows: int = ROWS, batch: int = 16, miss: float = 1e-7, star: bool = True,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document of ``docs`` (doc_id,
    text), linked where 100 * intersection >= ``similarity`` * union of shingle sets."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashes, limits = bands * rows, bounds(bands * rows, batch, similarity / 100, miss)
    found = durable(described(docs, size, hashes))
    each = found.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("n_shingles", "class")).alias("d")).select("doc_id", "d.*")
    members = durable(each)
    reps = members.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"))
    signed = durable(
        found.select(F.col("doc_id").alias("id"), "class", "signature").join(reps, ["id", "class"]).groupBy("id").agg(
            F.max("n").alias("n"), F.any_value("class").alias("class"), F.any_value("signature").alias("signature")
        )
    )
    band = signed.select("id", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "signature").select(
        F.xxhash64("band", F.substring("signature", F.col("band") * (4 * rows) + 1, F.lit(4 * rows))).alias("bucket"), "band", "id"
    )
    shared = band.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high").select("bucket")
    buckets = durable(band.join(shared, "bucket"))
    sought = buckets.select("id").distinct().join(signed, "id")
    sets = durable(sought.select("id", "n", "signature").join(shingle_sets(docs, sought.select("id", "class"), size), "id"))

    @F.pandas_udf("boolean")
    def likely(left: pd.Series, right: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), np.uint32).reshape(-1, hashes) for s in (left, right))
        alive, matches, seen = np.arange(len(a)), np.zeros(len(a), np.int64), 0
        for n, fewest in limits:
            matches[alive] += (a[alive, seen:n] == b[alive, seen:n]).sum(axis=1)
            alive, seen = alive[matches[alive] >= fewest], n
        out = np.zeros(len(a), bool)
        out[alive] = True
        return pd.Series(out)

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        def enough(x: bytes, y: bytes) -> bool:
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            return 100 * both >= similarity * (len(a) + len(b) - both)

        return pd.Series([enough(x, y) for x, y in zip(left, right, strict=True)])

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b; a < b) that are links."""
        narrow = sets.select("id", "n", "signature")
        sized = pairs.join(narrow.toDF("a", "n_a", "s_a"), "a").join(narrow.toDF("b", "n_b", "s_b"), "b")
        close = sized.where(100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
        left = durable(close.where(likely("s_a", "s_b")).select("a", "b"))
        full = left.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
        full = full.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
        return durable(full.where(linked("x", "y")).select("a", "b"))

    # One round of stars: every member against the smallest id of each of its buckets. Whoever
    # is linked to the same smallest id needs no comparing; the rest meets in blocks.
    several = buckets.groupBy("bucket").agg(F.min("id").alias("centre"))
    against = buckets.join(several, "bucket").where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    links = verified(durable(against.distinct())) if star else None
    now = buckets.withColumn("component", F.col("id"))
    if star:
        nearest = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component"))
        now = buckets.join(nearest, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    rest = links_between(durable(now.join(mixed, "bucket")), sets, hashes, rows, limits, similarity)
    stars_of = components(links.unionByName(rest) if star else rest)
    labelled = members.join(reps.select("class", F.col("id").alias("rep")), "class", "left")
    labelled = labelled.join(stars_of.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    out = labelled.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = found.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(nameless)


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the
    smallest id; rows that repeat an id are one document and stay or go together."""
    gone = near_duplicates(docs.select("doc_id", "text"), **how).where("not kept").select(F.col("doc_id").alias(" gone"))
    return docs.join(gone, docs["doc_id"] == gone[" gone"], "left_anti")
