"""Scoring texts with a Katz backoff model of word pairs.

P(w | h) is the discounted relative frequency of w after h where the pair was seen in
training, and alpha(h) * P(w) where it was not. Counts up to ``K`` are discounted by
Good and Turing's estimate, larger ones lose ``TAIL`` of a count, so that every context
keeps some mass; alpha(h) hands out exactly what the discounts of h left over, divided
by what P gives to the words not seen after h, so that P(. | h) sums to one. P is the
discounted relative frequency of words; what is left over there is the probability of
the one unknown word. A text ends with an end token and starts in a context of its own.

How it is computed. Texts are packed into blocks of some millions of tokens, a row
each: word hashes of the block, sorted, and every token as a place among them. Counting
is a round trip: a block asks for its distinct words and pairs, sorted and cut into
parts by hash, each part adds up what it was asked and answers the totals in the same
order. So a word that makes up a third of the corpus is one number per block, no
table is broadcast, and both directions carry only arrays. Among the blocks that ask
for a pair one is its owner and adds the pair's discounted mass and its word's
probability to the sums that alpha needs, per context and block, which are then
added up by context. Pairs are told apart by 48 bits within their part; the number of
parts grows with the corpus.

The tables of counts and of backoff weights are written to the shared folder, parted as
described, and read from there.

Defined cases: null text is empty and consists of the end token; rows without an id are
held out; rows that repeat an id are scored, and learnt, each; without training tokens
every token is unknown and the model's score is the base score; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.counting import answered, pack, parts_of, six_bytes, small, unpack
from starfold.llm.words import _MULTIPLIERS, mixed, word_hashes, words_of
from starfold.session import durable

BLOCK_TOKENS, PART_TOKENS = 1_000_000, 4_000_000
K, TAIL = 5, 0.1
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # hashes of the end token and of the first context


def planes(codes: np.ndarray) -> np.ndarray:
    """First all lowest bytes, then all next ones: small codes pack well so."""
    return codes.view(np.uint8).reshape(-1, 4).T


def unplaned(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


def blocks(docs: DataFrame, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block of whole texts (doc_id, text, held)."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, made = f"{TaskContext.get().partitionId()}", 0
        ids, held, hashes, size = [], [], [], 0

        def block() -> pd.DataFrame:
            every = np.concatenate(hashes)
            lengths = np.array([len(h) for h in hashes], np.int64)
            vocabulary, codes, counts = np.unique(every, return_inverse=True, return_counts=True)
            rank = np.empty(len(vocabulary), np.uint32)
            order = np.argsort(-counts, kind="stable").astype(np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)  # frequent words get small codes, which pack well
            named = np.array([i is not None and i == i for i in ids])
            numbers = np.array([int(i) if n else 0 for i, n in zip(ids, named, strict=True)], np.int64)
            return pd.DataFrame([{
                "block": f"{own}-{made}", "ids": pack(numbers), "named": pack(named), "held": pack(np.array(held, bool)), "lengths": pack(lengths),
                "vocabulary": pack(vocabulary), "order": pack(order), "codes": pack(planes(rank[codes])),
            }])

        for batch in batches:
            for i, text, out in zip(batch["doc_id"].astype(object), batch["text"], batch["held"], strict=True):
                ids.append(None if pd.isna(i) else i)
                held.append(out)
                hashes.append(np.append(word_hashes(words_of(text, lower=True)), END))
                size += len(hashes[-1])
                if size >= tokens:
                    yield block()
                    made += 1
                    ids, held, hashes, size = [], [], [], 0
        if ids:
            yield block()

    schema = "block string, ids binary, named binary, held binary, lengths binary, vocabulary binary, order binary, codes binary"
    return docs.mapInPandas(packed, schema)


@dataclass
class Block:
    """A block laid out for computing: per token its text, word, context and pair."""

    row: dict

    def __post_init__(self):
        self.ids, self.named = unpack(self.row["ids"], "int64"), unpack(self.row["named"], "bool")
        self.held, self.lengths = unpack(self.row["held"], "bool"), unpack(self.row["lengths"], "int64")
        self.vocabulary = unpack(self.row["vocabulary"], "uint64")
        self.word = unpack(self.row["order"], "uint32")[unplaned(unpack(self.row["codes"], "uint8"))]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)

    def contexts(self) -> np.ndarray:
        """Place of each token's context in the vocabulary; its length for the start."""
        before = np.empty(len(self.word), np.uint32)
        before[1:] = self.word[:-1]
        before[self.starts] = len(self.vocabulary)
        return before

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pair keys, sorted; where each first stands; each token's place among them."""
        keys = np.append(self.vocabulary, START)[self.contexts()]
        keys *= _MULTIPLIERS[0]
        words = self.vocabulary[self.word]
        words *= _MULTIPLIERS[1]
        keys += words
        del words
        keys = mixed(keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        inverse = np.empty(len(order), np.uint32)
        inverse[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        return keys[new], order[new], inverse


def asked(packed: DataFrame, pairs: bool, parts: int) -> DataFrame:
    """What each block asks of each part: keys and their training counts in the block."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.iloc[i].to_dict()
                b = Block(row)
                keys, inverse = (b.vocabulary, b.word) if not pairs else b.pairs()[::2]
                counts = np.bincount(inverse, b.training(), len(keys)).astype(np.uint64)
                edges = parts_of(keys, parts)
                low = six_bytes(keys, parts) if pairs else None
                out = [
                    {"part": p, "block": row["block"], "keys": pack(low[i:j].T) if pairs else pack(keys[i:j]), "counts": pack(small(counts[i:j]))}
                    for p, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if i < j
                ]
                yield pd.DataFrame(out)

    return packed.mapInPandas(ask, "part int, block string, keys binary, counts binary")


def totals_of(answers: DataFrame) -> list[int]:
    """Keys with counts 1 to K + 1, all keys, all tokens: sums over the parts."""
    sums = answers.where("block is null").agg(*[F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(K + 3)]).first()
    return [int(v) for v in sums]


def kept_share(of_counts: list[int]) -> np.ndarray:
    """What is kept of counts 0 to K; where the estimate is no discount, half a count goes."""
    kept, common = [1.0], (K + 1) * of_counts[K] / of_counts[0] if of_counts[0] else 1.0
    for r in range(1, K + 1):
        n, above = of_counts[r - 1], of_counts[r]
        share = ((r + 1) * above / (n * r) - common) / (1 - common) if n and common < 1 else 0.0
        kept.append(share if 0 < share < 1 else 1 - 0.5 / r)
    return np.array(kept)


def discounted(counts: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Counts after discounting; zero stays zero."""
    return np.where(counts > K, counts - TAIL, counts * kept[np.minimum(counts, K).astype(np.int64)])


#: Rows and bytes that Spark hands to a Python worker at once; whole texts and packed blocks are long.
BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def score(docs: DataFrame, *, block_tokens: int = BLOCK_TOKENS, part_tokens: int = PART_TOKENS, batch_rows: int = 500, batch_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every
    row of ``docs`` (doc_id, text, held); rows that are held train nothing."""
    conf = docs.sparkSession.conf
    before = {name: conf.get(name) for name in (BATCH_ROWS, BATCH_BYTES)}
    conf.set(BATCH_ROWS, str(batch_rows))
    conf.set(BATCH_BYTES, str(batch_bytes))
    try:  # all stages in Python are written down before this returns
        return _score(docs, block_tokens, part_tokens)
    finally:
        for name, value in before.items():
            conf.set(name, value)


#: What a block makes of its texts; see ``evaluate``.
ROWS = pa.schema([
    ("kind", pa.int32()), ("block", pa.string()), ("at", pa.int32()), ("id", pa.int64()), ("named", pa.bool_()), ("held", pa.bool_()),
    ("n", pa.int64()), ("known", pa.int64()), ("x", pa.float64()), ("y", pa.float64()),
])


def rows(kind: int, block: str, **values: np.ndarray) -> pa.RecordBatch:
    """Rows of one kind; columns without values are null."""
    n = len(values["id"])
    values |= {"kind": pa.repeat(pa.scalar(kind, pa.int32()), n), "block": pa.repeat(block, n)}
    return pa.record_batch([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in ROWS], schema=ROWS)


def _score(docs: DataFrame, block_tokens: int, part_tokens: int) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("held", F.lit(True)).alias("held"))
    packed = durable(blocks(narrow, block_tokens))

    @F.pandas_udf("long")
    def size(lengths: pd.Series) -> pd.Series:
        return lengths.map(lambda x: int(unpack(x, "int64").sum()))

    tokens, texts = packed.agg(F.coalesce(F.sum(size("lengths")), F.lit(0)), F.count("*")).first()
    parts = max(packed.sparkSession.sparkContext.defaultParallelism, -(-tokens // part_tokens))
    words = durable(answered(asked(packed, False, parts), 8, K + 1))
    pairs = durable(answered(asked(packed, True, parts), 6, K + 1))
    *word_counts, types, total = totals_of(words)
    pair_counts = totals_of(pairs)[:-2]
    word_kept, pair_kept = kept_share(word_counts), kept_share(pair_counts)
    small_types = sum(word_counts[:K])
    small_mass = sum(r * n * word_kept[r] for r, n in enumerate(word_counts[:K], 1))
    small_tokens = sum(r * n for r, n in enumerate(word_counts[:K], 1))
    seen_mass = small_mass + (total - small_tokens) - TAIL * (types - small_types)
    unknown = 1 - seen_mass / total if total else 1.0

    @F.pandas_udf("long")
    def trained(held: pd.Series) -> pd.Series:
        return held.map(lambda x: int((~unpack(x, "bool")).sum()))

    train_texts = packed.agg(F.coalesce(F.sum(trained("held")), F.lit(0))).first()[0]

    def evaluate(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        """kind 0: a text's sums; kind 1: a text's words unseen after a context; kind 2:
        what the block adds to the sums of a context."""
        b, block = Block(own.to_pylist()[0]), key[0].as_py()

        def read(pair: bool, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            totals, owned = np.zeros(edges[-1], np.int64), np.zeros(edges[-1], bool)
            for batch in answers.to_batches():
                for p, t, o, of_pair in zip(*(batch.column(c) for c in ("part", "totals", "owned", "pair")), strict=True):
                    if of_pair.as_py() == pair:
                        p = p.as_py()
                        n, plain = edges[p + 1] - edges[p], zstandard.decompress(t.as_buffer())
                        totals[edges[p]:edges[p + 1]] = np.frombuffer(plain, f"u{len(plain) // n}")
                        owned[edges[p]:edges[p + 1]] = np.unpackbits(np.frombuffer(zstandard.decompress(o.as_buffer()), np.uint8), count=n).astype(bool)
            return totals, owned

        count = read(False, parts_of(b.vocabulary, parts))[0]
        keys, first, inverse = b.pairs()
        both, owned = read(True, parts_of(keys, parts))
        context = b.contexts()
        h, w = context[first], b.word[first]
        del keys, first
        after = np.append(count, train_texts)  # every training word is followed by one token
        lower = np.where(count > 0, discounted(count, word_kept) / max(total, 1), unknown)
        base = np.log10((count + 0.1) / (total + 0.1 * (types + 1)))
        with np.errstate(divide="ignore", invalid="ignore"):
            share = discounted(both, pair_kept) / after[h]
            known = np.where(both > 0, np.log10(share), np.where(after[h] > 0, 0.0, np.log10(lower[w])))  # no such context: the word alone

        texts = len(b.lengths)
        out = [rows(
            0, block, at=np.arange(texts), id=np.where(b.named, b.ids, 0), named=b.named, held=b.held, n=b.lengths,
            known=np.add.reduceat((count > 0)[b.word], b.starts, dtype=np.int64),
            x=np.add.reduceat(base[b.word], b.starts), y=np.add.reduceat(known[inverse], b.starts),
        )]
        del known
        missing = np.flatnonzero((both[inverse] == 0) & (after[context] > 0))
        del inverse
        hashes = np.append(b.vocabulary, START).view(np.int64)
        at = np.searchsorted(b.starts, missing, "right") - 1  # every text has a token
        unseen = pd.DataFrame({"at": at, "id": hashes[context[missing]], "x": np.log10(lower[b.word[missing]]), "n": 1})
        del missing, at, context
        unseen = unseen.groupby(["at", "id"], as_index=False).sum()
        out.append(rows(1, block, **{c: unseen[c].to_numpy() for c in unseen}))
        del unseen
        mine = np.flatnonzero(owned & (both > 0))
        used = np.bincount(h[mine], share[mine], len(after))
        given = np.bincount(h[mine], lower[w[mine]], len(after))
        some = np.flatnonzero(used > 0)
        out.append(rows(2, block, id=hashes[some], x=used[some], y=given[some]))
        return pa.Table.from_batches(out)

    columns = ["block", "part", "totals", "owned"]
    answers = words.where("block is not null").select(*columns, F.lit(False).alias("pair")).unionByName(
        pairs.where("block is not null").select(*columns, F.lit(True).alias("pair"))
    )
    made = durable(packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(evaluate, "kind int, block string, at int, id long, named boolean, held boolean, n long, known long, x double, y double"))
    weights = durable(made.where("kind = 2").groupBy(F.col("id").alias("context")).agg(F.sum("x").alias("used"), F.sum("y").alias("given")).select(
        "context", F.log10((1 - F.col("used")) / (1 - F.col("given"))).alias("weight")
    ))
    unseen = made.where("kind = 1").select("block", "at", F.col("id").alias("context"), "n", "x").join(weights, "context")
    backed = unseen.groupBy("block", "at").agg(F.sum(F.col("x") + F.col("n") * F.col("weight")).alias("z"))
    return made.where("kind = 0").join(backed, ["block", "at"], "left").select(
        F.when(F.col("named"), F.col("id")).alias("doc_id"), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), F.col("x").alias("base_score"),
        (F.col("y") + F.coalesce("z", F.lit(0.0)) if total else F.col("x")).alias("score"),
    )
