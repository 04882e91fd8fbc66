"""The packed Katz model against one of dictionaries."""

import math
import zlib
from collections import Counter

import pytest

from starfold.llm import katz


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    return [w for w in lowered.split(" ") if w] + [None]


def plain(rows):
    """doc_id -> (n_tokens, n_known, train_tokens, base, score), and P(w | h)."""
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    words, pairs, contexts = Counter(), Counter(), Counter()
    for i, text in rows:
        if not held[i]:
            before = "START"
            for w in tokens(text):
                words[w] += 1
                pairs[before, w] += 1
                contexts[before] += 1
                before = (w,)
    total, types = sum(words.values()), len(words)

    def kept(counter):
        of = Counter(min(c, katz.K + 2) for c in counter.values())
        return katz.kept_share([of[r] for r in range(1, katz.K + 2)])

    word_kept, pair_kept = kept(words), kept(pairs)

    def cut(c, k):
        return c - katz.TAIL if c > katz.K else c * k[c]

    unknown = 1 - sum(cut(c, word_kept) for c in words.values()) / total

    def single(w):
        return cut(words[w], word_kept) / total if words[w] else unknown

    def given(w, h):
        if not contexts[h]:
            return single(w)
        if pairs[h, w]:
            return cut(pairs[h, w], pair_kept) / contexts[h]
        after = [v for g, v in pairs if g == h]
        left = 1 - sum(cut(pairs[h, v], pair_kept) for v in after) / contexts[h]
        return left / (1 - sum(map(single, after))) * single(w)

    out = {}
    for i, text in rows:
        own, before, score = tokens(text), "START", 0.0
        for w in own:
            score += math.log10(given(w, before))
            before = (w,)
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (types + 1))) for w in own)
        out[i] = (len(own), sum(words[w] > 0 for w in own), total, base, score)
    return out, given, words, contexts


def scored(spark, rows, **sizes):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    found = katz.score(docs.select("doc_id", "text", held.alias("held"), F.lit(1).alias("n_tokens")), **sizes).collect()
    return {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found}, found


def test_scores_equal_those_of_dictionaries(spark):
    import random

    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ä", "THE", "the"]
    rows = [(i, " ".join(draw.choices(vocabulary, [1 / (k + 1) for k in range(63)], k=draw.randint(0, 60)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "unheard of words here"), (203, "w0\tw1\nw2  w0"), (None, "w0 w1 w2")]
    expected, given, words, contexts = plain(rows)
    found, raw = scored(spark, rows, block_tokens=300, part_tokens=500)
    assert len(raw) == len(rows)
    for i, e in expected.items():
        assert found[i][:3] == e[:3]
        assert found[i][3:] == pytest.approx(e[3:], rel=1e-9)
    for h in list(contexts)[:12]:
        whole = sum(given(w, h) for w in words) + given("never seen", h)
        assert whole == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from(spark):
    held_out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    found, _ = scored(spark, [(held_out, "some words")])
    n, known, trained, base, score = found[held_out]
    assert (n, known, trained) == (3, 0, 0) and score == base
    assert scored(spark, [])[1] == []


def requests_of(keys_a_block, blocks, distinct, seed=5):
    """Requests of one part, and the total of every key."""
    import numpy as np
    import pandas as pd

    from starfold.llm.counting import pack, small

    draw = np.random.default_rng(seed)
    known = np.unique(draw.integers(0, 1 << 48, distinct, np.uint64))
    out, all_of = [], Counter()
    for i in range(blocks):
        keys = np.sort(draw.choice(known, min(keys_a_block, len(known)), replace=False))
        counts = draw.integers(0, 4 if i else 70_000, len(keys)).astype(np.uint64)
        all_of.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        low = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)[:, :6]
        out.append({"part": 3, "block": f"b{i}", "keys": pack(low.T), "counts": pack(small(counts)), "plain": keys})
    return pd.DataFrame(out), all_of


def test_a_part_adds_up_slice_by_slice():
    import numpy as np

    from starfold.llm.counting import added, unpack

    requests, all_of = requests_of(500, 7, 900)
    for slice_keys in (10**6, 300, 1):
        answers = added(requests.drop(columns="plain"), 6, 6, slice_keys)
        owners = Counter()
        for (_, r), (_, a) in zip(requests.iterrows(), answers.iterrows(), strict=False):
            plain = unpack(a["totals"], "uint8")
            totals = plain.view(f"u{len(plain) // len(r['plain'])}")
            assert a["block"] == r["block"] and totals.tolist() == [all_of[k] for k in r["plain"].tolist()]
            own = np.unpackbits(unpack(a["owned"], "uint8"), count=len(totals)).astype(bool)
            owners.update(r["plain"][own].tolist())
        assert set(owners) == set(all_of) and set(owners.values()) == {1}
        of = Counter(all_of.values())
        last = answers.iloc[-1]
        assert last["block"] is None
        assert last["stats"] == [*(of[c] for c in range(1, 7)), sum(v > 0 for v in all_of.values()), sum(all_of.values())]


def peak_of(act):
    import tracemalloc

    tracemalloc.start()
    try:
        act()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_part_takes_little_memory_a_key():
    from starfold.llm.counting import added

    requests, _ = requests_of(60_000, 10, 200_000)
    rows = requests.drop(columns="plain")
    assert peak_of(lambda: added(rows, 6, 6, 1 << 15)) < 28 * 600_000


def test_a_block_is_short_and_pairs_take_little_memory():
    import numpy as np

    from starfold.llm.counting import pack

    draw = np.random.default_rng(5)
    n = 200_000
    codes = np.minimum(draw.zipf(1.3, n), 20_000).astype(np.uint32) - np.uint32(1)
    assert (katz.unplaned(katz.planes(codes).ravel()) == codes).all()
    assert len(pack(katz.planes(codes))) < 0.8 * len(pack(codes))
    vocabulary = np.sort(draw.integers(0, 1 << 63, 20_000, np.uint64))
    lengths = np.full(100, n // 100)
    b = katz.Block({
        "ids": pack(np.arange(100)), "named": pack(np.ones(100, bool)), "held": pack(np.zeros(100, bool)), "lengths": pack(lengths),
        "vocabulary": pack(vocabulary), "order": pack(np.arange(20_000, dtype=np.uint32)), "codes": pack(katz.planes(codes)),
    })
    found = []
    assert peak_of(lambda: found.extend(b.pairs())) < 45 * n
    keys, first, inverse = found
    pairs = list(zip(b.contexts().tolist(), b.word.tolist(), strict=True))
    assert len(set(pairs)) == len(keys) and (np.diff(keys.astype(object)) > 0).all()
    assert all(pairs[first[i]] == p for i, p in zip(inverse, pairs, strict=True))


def test_keys_of_a_part_keep_order_and_pack_well():
    import numpy as np

    from starfold.llm.counting import pack, parts_of, six_bytes

    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 64, 200_000, np.uint64))
    for parts in (1, 3, 34, 70_000):
        low, edges = six_bytes(keys, parts), parts_of(keys, parts)
        wide = np.zeros((len(low), 8), np.uint8)
        wide[:, :6] = low
        within = wide.view(np.uint64).ravel()
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            steps = within[i:j].tolist()
            assert min(steps[1:], default=1) > 0 and sum(steps) < 1 << 48
    low = six_bytes(keys, 8)[:parts_of(keys, 8)[1]]
    assert len(pack(low.T)) < 0.8 * low.size
