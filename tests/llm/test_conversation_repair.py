"""Repairs against exhaustive search, and the query against a plain version."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from starfold.llm import conversation_repair as repair
from starfold.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, messages) of rows (role, text, fault) by plain recursion over strings."""

    @lru_cache(None)
    def best(i, state, inserted):
        ends = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        follows = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[follows]
        if inserted < 4:
            c, a, m = best(i, follows, inserted + 1)
            ends.append((c + 2, "I" + a, ((name, ""), *m)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, m = best(i + 1, state, 0)
            ends.append((c + 3, "D" + a, m))
            if fault not in ("blank", "duplicate"):
                late = int(fault == "truncated")
                c, a, m = best(i + 1, follows, 0)
                ends.append((c + 2 + late, "R" + a, ((name, text), *m)))
                if role[:1] == follows or (role[:1] == "s" and state == ""):
                    c, a, m = best(i + 1, role[0], 0)
                    ends.append((c + late, "K" + a, ((role, text), *m)))
        return min(ends) if ends else (10**9, "", ())

    return best(0, "", 0)


def plain(turns):
    """All columns of the query for rows (conv_id, turn, role, text), by the contract."""
    groups = {}
    for conv, turn, role, text in turns:
        rows = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind <= 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        counts, seen, faulty = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}, set(), []
        for _, role, text in rows:
            fault = "blank" if not text.strip(SPACES) else "duplicate" if (role, text) in seen else "truncated" if text.rstrip(SPACES)[-1] not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            faulty.append((role, text, fault))
        known = {t for t, _, _ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, messages = cheapest(tuple(faulty))
        found[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest(),
        )
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows_of(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query_equals_plain_version(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op11_conversation_repair"](spark, FOLDER)
    assert rows_of(df) == plain(turns)


def odd(seed, conversations=25, rows=12):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", None, "Well! ", "Well!", "x" * 3000 + ".", "…", "a.\x0b", "a.\x85"]
    roles = ["user", "assistant", "system", "tool", "", None, "usher"]
    return [
        (rnd.choice([None, *range(conversations)]), rnd.choice([None, *range(rows)]), rnd.choice(roles[:3] * 3 + roles), rnd.choice(texts))
        for _ in range(conversations * rows)
    ]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumn("piece", F.lit("a clashing column")).withColumn("copies", F.lit(7)).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("held, block", [(20_000, 4_096), (3, 2), (0, 5)])
def test_ties_nulls_repeats_and_blocks(spark, seed, held, block):
    rows = odd(seed)
    found = repair.repair(repair.damaged(frame(spark, rows)), rows_held=held, block=block)
    assert rows_of(repair.digests(*found)) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["Fine.", "Cut", f"No {t}."])) for t in range(900)] + odd(6, 5, 4)
    found = repair.repair(repair.damaged(frame(spark, rows)), rows_held=50, block=16)
    mine, wanted = rows_of(repair.digests(*found)), plain([r for r in rows if r[0] != 1])
    assert {k: v for k, v in mine.items() if k != 1} == wanted
    whole = repair.repair(repair.damaged(frame(spark, [r for r in rows if r[0] == 1])), rows_held=10**6, bytes_held=1 << 40)
    one = repair.damaged(frame(spark, [r for r in rows if r[0] in (1, 2)]))
    assert rows_of(repair.digests(*whole))[1] == mine[1] == rows_of(repair.digests(*repair.repair(one, rows_held=10**6)))[1]


def test_dropped_conversations_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = rows_of(repair.digests(*repair.repair(repair.damaged(frame(spark, [(gone, 0, "user", "Hi."), (None, None, None, None)])))))
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found == plain([(gone, 0, "user", "Hi."), (None, None, None, None)])
    assert repair.digests(*repair.repair(repair.damaged(frame(spark, [])))).collect() == []


def test_runs_equal_single_steps():
    rnd = random.Random(3)
    for _ in range(200):
        symbols = [rnd.choice([0, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rnd.randint(0, 6)) for _ in range(rnd.randint(1, 9))]
        runs = repair.runs_of(symbols)
        costs = repair.END
        for s in reversed(symbols):
            costs = repair.crossed_once(s, costs)
        total = repair.matrix_of(runs) + [list(repair.END)] * 4
        assert tuple(total.min(axis=1)) == costs and repair.solved(tuple(runs))[0] == costs[0]
