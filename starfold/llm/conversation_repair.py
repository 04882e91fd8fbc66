"""Repair of conversation structure by the cheapest edits, as a run-length dynamic program.

The rows of a conversation, in the order of their turns, become symbols: the initial of the
role and the row's fault. Every symbol is a min-plus matrix over four states of the wanted
order ``(s?(ua)+)?`` (nothing yet, after s, after u, after a), insertions included. Equal
neighbouring symbols are a run; a run is crossed by the cached powers 1, 2, 4, ... of its
matrix. Costs to go are carried backwards over the runs, then the choices are unrolled
forwards, always the ASCII-least letter that stays cheapest, which gives the audit: one
letter an edit, (D)elete, (I)nsert, (K)eep, (R)erole.

Rows are sorted by range over all tasks, wherever a conversation falls. A conversation
that lies inside one task is solved there. One that crosses tasks, or is larger than
``rows_held`` rows, is cut into blocks of ``block`` rows: each block gives the matrix of its
runs, the few matrices of a conversation give every block its costs to go, the blocks are
unrolled on their own for each state they may be entered in, and the entered states pick
one. A third of all rows may thus be one conversation. Only its audit, a single value by
definition, and the digest of its text, sequential by definition, pass one task, the text
batch by batch.

Faults, the first that holds: blank (no character but blanks and controls 9 to 13),
duplicate (role and text of an earlier row), truncated (the last such character is not one
of ``.!?``). Defined cases: null role or text is one space; a null turn comes first; rows
of one turn are taken by role, then by the digest of role and text (equal rows are
interchangeable); a null conversation id is a conversation of its own; any other role
counts by its first character, an empty one has none; texts are hashed and carried whole;
repeated rows are duplicates; extra columns are ignored; an empty table has no
conversations; a conversation whose rows were all dropped is reported with zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.session import durable

NEVER = 1 << 60
DELETE = 8
#: Where an insertion (or a new role) leads from each state, and its initial.
NEXT = (2, 2, 3, 2)
#: Cost of ending in each state, closing insertions included.
END = (0, 4, 2, 0)
_GAPS = np.array([[0, NEVER, 2, 4], [NEVER, 0, 2, 4], [NEVER, NEVER, 0, 2], [NEVER, NEVER, 2, 0]], np.int64)


def kept_to(symbol: int, state: int) -> int | None:
    """Where keeping a row leads, if it may be kept."""
    if symbol == DELETE:
        return None
    initial = symbol // 2
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return None if state == 2 else 2
    return 3 if initial == 2 and state == 2 else None


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


@lru_cache(None)
def power(symbol: int, k: int) -> np.ndarray:
    """The transition of 2**k rows with one symbol."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    row = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        row[state, state] = 3
        if symbol != DELETE:
            late = symbol % 2
            row[state, NEXT[state]] = min(row[state, NEXT[state]], 2 + late)
            kept = kept_to(symbol, state)
            if kept is not None:
                row[state, kept] = min(row[state, kept], late)
    return times(_GAPS, row)


def crossed(symbol: int, length: int, after: tuple) -> tuple:
    """Costs to go before a run, from those after it."""
    costs, k = np.array(after, np.int64), 0
    while length >> k:
        if length >> k & 1:
            costs = np.minimum((power(symbol, k) + costs[None, :]).min(axis=1), NEVER)
        k += 1
    return tuple(costs.tolist())


def matrix_of(runs: list[tuple[int, int]]) -> np.ndarray:
    total = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(total, 0)
    for symbol, length in runs:
        k = 0
        while length >> k:
            if length >> k & 1:
                total = times(total, power(symbol, k))
            k += 1
    return total


@lru_cache(1 << 16)
def crossed_once(symbol: int, after: tuple) -> tuple:
    return crossed(symbol, 1, after)


@lru_cache(1 << 16)
def _lowered(costs: tuple) -> tuple:
    """Choices depend on differences only, so that few vectors occur in a long run."""
    return tuple(c - min(costs) for c in costs)


@lru_cache(1 << 16)
def _choice(symbol: int, state: int, before: tuple, after: tuple) -> tuple[str, int]:
    letters = ""
    while True:
        cost = before[state]
        if 3 + after[state] == cost:
            return letters + "D", state
        if 2 + before[NEXT[state]] == cost:
            letters, state = letters + "I", NEXT[state]
            continue
        kept = kept_to(symbol, state)
        if kept is not None and symbol % 2 + after[kept] == cost:
            return letters + "K", kept
        return letters + "R", NEXT[state]


def runs_of(symbols: list[int]) -> list[tuple[int, int]]:
    return [(s, len(list(g))) for s, g in groupby(symbols)]


def unrolled(runs: list[tuple[int, int]], after: tuple, state: int) -> tuple[str, int]:
    """Letters of all rows of ``runs`` entered in ``state``, and the state they leave."""
    ends, letters = [after], []
    for symbol, length in reversed(runs):
        ends.append(crossed(symbol, length, ends[-1]))
    for (symbol, length), end in zip(runs, ends[-2::-1], strict=True):
        steps, low = [], _lowered(end)
        for _ in range(length):
            before = crossed_once(symbol, low)
            steps.append((before, low))
            low = _lowered(before)
        for before, low in reversed(steps):
            some, state = _choice(symbol, state, before, low)
            letters.append(some)
    return "".join(letters), state


def solved(runs: tuple) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    costs = END
    for symbol, length in reversed(runs):
        costs = crossed(symbol, length, costs)
    letters, state = unrolled(list(runs), END, 0)
    return costs[0], letters + "I" * (END[state] // 2)


@lru_cache(1 << 14)
def solved_often(runs: tuple) -> tuple[int, str]:
    """The same for short conversations, which mostly look alike."""
    return solved(runs)


def apply(letters: str, state: int, rows: Iterator[tuple[str, str]]) -> tuple[list[tuple[str, str]], int]:
    """The repaired (role, text) that ``letters`` make of ``rows``, entered in ``state``."""
    out = []
    for letter in letters:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter == "K":
            state = kept_to(symbol_of(role, ""), state)
        else:
            state = NEXT[state]
            role = "assistant" if state == 3 else "user"
        out.append((role, text))
    return out, state


def symbol_of(role: str, fault: str) -> int:
    if fault in ("blank", "duplicate"):
        return DELETE
    return 2 * ("sua".find(role[0]) % 4 if role else 3) + (fault == "truncated")


def is_illegal(before: str, after: str) -> bool:
    return before[:1] + after[:1] not in ("su", "ua", "au")


def damaged(turns: DataFrame) -> DataFrame:
    """What a lossy log keeps of ``turns`` (conv_id, turn, role, text), by the checksum of
    conversation and turn: rows with the number of their copies, 0 for a dropped one."""
    space = F.lit(" ")
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name) % 20
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _own_fault(text: Column) -> Column:
    """The fault of a row on its own."""
    trimmed = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")


_WHOLE = "rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_MESSAGES = "messages array<struct<role: string, text: string>>"
_ROW = "piece int, at long, turn long, role string, text string, fault string, digest binary, copies int"


def _solver(rows_held: int, bytes_held: int):
    schema = pa.schema([
        ("conv_id", pa.int64()), *[(n, pa.int64()) for n in "rows gaps blank duplicate truncated illegal cost".split()], ("audit", pa.string()),
        ("messages", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
        ("piece", pa.int32()), ("at", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()),
        ("digest", pa.binary()), ("copies", pa.int32()),
    ])

    def whole(conv: int | None, rows: list[tuple]) -> dict:
        seen, said, symbols, counts = set(), [], [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        turns, illegal = set(), 0
        for turn, role, text, fault, digest, copies in rows:
            for _ in range(copies):
                first = fault if fault == "blank" else "duplicate" if digest in seen else fault
                seen.add(digest)
                counts[first] += 1
                illegal += bool(said) and is_illegal(said[-1][0], role)
                said.append((role, text))
                symbols.append(symbol_of(role, first))
                if turn is not None:
                    turns.add(turn)
        runs = tuple(runs_of(symbols))
        cost, audit = (solved_often if len(symbols) <= 64 else solved)(runs)
        messages, _ = apply(audit, 0, iter(said))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        return {
            "conv_id": conv, "rows": len(said), "gaps": gaps, "blank": counts["blank"], "duplicate": counts["duplicate"], "truncated": counts["truncated"],
            "illegal": illegal, "cost": cost, "audit": audit, "messages": [{"role": r, "text": t} for r, t in messages],
        }

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at, out, size = TaskContext.get().partitionId(), 0, [], 0
        # The conversation in hand; the first and the last of a task may go on in others.
        conv, held, held_bytes, loose, begun = None, [], 0, True, False

        def raw(r: tuple) -> dict:
            nonlocal at, size
            at, size = at + 1, size + len(r[2])
            return dict(zip(("conv_id", "piece", "at", "turn", "role", "text", "fault", "digest", "copies"), (conv, piece, at, *r), strict=True))

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "digest", "copies")]
            for own, *rest in zip(*columns, strict=True):
                if own != conv or not begun:
                    if held:
                        out.append(whole(conv, held))
                        size += held_bytes
                    conv, held, held_bytes, loose, begun = own, [], 0, not begun, True
                if loose:
                    out.append(raw(tuple(rest)))
                else:
                    held.append(tuple(rest))
                    held_bytes += len(rest[2])
                    if len(held) > rows_held or held_bytes > bytes_held:
                        out += [raw(r) for r in held]
                        held, loose = [], True
                if size > 8 << 20 or len(out) > 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
        out += [raw(r) for r in held]
        yield pa.RecordBatch.from_pylist(out, schema)

    return solve


def repair(rows: DataFrame, *, rows_held: int = 20_000, bytes_held: int = 32 << 20, block: int = 4_096) -> tuple[DataFrame, DataFrame]:
    """Repairs of conversations given as ``rows`` (conv_id, turn, role, text, copies).

    The first table has a row per conversation: its rows, gaps, faults, cost and audit, and
    its repaired ``messages``. Those are null for conversations that were solved in blocks;
    the second table holds their messages by (conv_id, piece, block), in that order.
    """
    named = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    fault, digest = _own_fault(F.col("text")), F.unhex(F.sha2(named.cast("binary"), 256))
    keyed = rows.select(
        "conv_id", "turn", "role", F.when(F.col("copies") > 0, F.col("text")).otherwise("").alias("text"), fault.alias("fault"), digest.alias("digest"),
        "copies", F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "role", "digest", "row"]
    pieces = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    ordered = keyed.repartitionByRange(pieces, *order).sortWithinPartitions(*order).drop("row")
    done = durable(ordered.mapInArrow(_solver(rows_held, bytes_held), f"conv_id long, {_WHOLE}, {_MESSAGES}, {_ROW}"))
    names = [c.split()[0] for c in _WHOLE.split(", ")]
    inside = done.where("piece is null").select("conv_id", *names, "messages")
    loose = done.where("piece is not null").select("conv_id", *[c.split()[0] for c in _ROW.split(", ")])
    report, parts = _in_blocks(loose, block)
    return inside.unionByName(report, allowMissingColumns=True), parts


def _in_blocks(loose: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The same for rows of conversations that lie in several tasks."""
    narrow = loose.select("conv_id", "piece", "at", "turn", "role", "fault", "digest", "copies")
    live = narrow.where("copies > 0")
    place = F.struct("piece", "at")
    firsts = live.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("conv_id", "digest", "first")
    same = (F.col("l.conv_id").eqNullSafe(F.col("f.conv_id"))) & (F.col("l.digest") == F.col("f.digest"))
    late = F.col("first").isNotNull() & (F.struct("l.piece", "l.at") != F.col("first"))
    marked = live.alias("l").join(firsts.alias("f"), same, "left").select(
        "l.conv_id", "piece", "at", (F.col("at") / size).cast("long").alias("block"), "role", "copies",
        F.when((F.col("fault") != "blank") & late, "duplicate").otherwise(F.col("fault")).alias("fault"),
    )
    key = ["conv_id", "piece", "block"]

    def summary(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        symbols, roles, counts = [], [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for role, fault, copies in zip(rows["role"], rows["fault"], rows["copies"], strict=True):
            for first in [fault, fault if fault == "blank" else "duplicate"][:copies]:
                symbols.append(symbol_of(role, first))
                roles.append(role)
                counts[first] += 1
        runs = runs_of(symbols)
        illegal = sum(is_illegal(a, b) for a, b in zip(roles, roles[1:]))
        return pd.DataFrame([{
            **{k: None if pd.isna(rows[k].iloc[0]) else int(rows[k].iloc[0]) for k in key}, "rows": len(symbols), "blank": counts["blank"],
            "duplicate": counts["duplicate"], "truncated": counts["truncated"], "illegal": illegal, "opens": roles[0], "closes": roles[-1],
            "symbols": [s for s, _ in runs], "lengths": [n for _, n in runs], "matrix": matrix_of(runs).ravel().tolist(),
        }]).astype({"conv_id": "Int64"})

    blocks = durable(marked.groupBy(*key).applyInPandas(summary, (
        "conv_id long, piece int, block long, rows long, blank long, duplicate long, truncated long, illegal long, opens string, closes string, "
        "symbols array<int>, lengths array<int>, matrix array<long>"
    )))

    def costs_to_go(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["piece", "block"]).reset_index(drop=True)
        costs, after = np.array(END, np.int64), []
        for m in reversed(rows["matrix"]):
            after.append(costs.tolist())
            costs = np.minimum((np.asarray(m, np.int64).reshape(4, 4) + costs[None, :]).min(axis=1), NEVER)
        joints = sum(is_illegal(a, b) for a, b in zip(rows["closes"], rows["opens"][1:]))
        out = rows[key].astype({"conv_id": "Int64"})
        out["after"], out["cost"], out["joints"], out["last"] = after[::-1], int(costs[0]), joints, out.index == len(out) - 1
        return out

    narrow_blocks = blocks.select(*key, "opens", "closes", "matrix")
    ahead = narrow_blocks.groupBy("conv_id").applyInPandas(costs_to_go, "conv_id long, piece int, block long, after array<long>, cost long, joints long, last boolean")
    matched = (F.col("b.conv_id").eqNullSafe(F.col("a.conv_id"))) & (F.col("b.piece") == F.col("a.piece")) & (F.col("b.block") == F.col("a.block"))
    joined = blocks.alias("b").join(ahead.alias("a"), matched).select("b.*", "after", "cost", "joints", "last")

    def ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for symbols, lengths, after, last in zip(batch["symbols"], batch["lengths"], batch["after"], batch["last"], strict=True):
                four = [unrolled(list(zip(symbols, lengths, strict=True)), tuple(map(int, after)), state) for state in range(4)]
                found.append(([letters + "I" * (END[left] // 2 if last else 0) for letters, left in four], [left for _, left in four]))
            out = batch.drop(columns=["symbols", "lengths", "after", "matrix"]).astype({"conv_id": "Int64"})
            out["audits"], out["leaves"] = [a for a, _ in found], [s for _, s in found]
            yield out

    kept = "conv_id long, piece int, block long, rows long, blank long, duplicate long, truncated long, illegal long, opens string, closes string, cost long, joints long, last boolean"
    four = joined.mapInPandas(ways, f"{kept}, audits array<string>, leaves array<int>")

    def chosen(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["piece", "block"]).reset_index(drop=True)
        state, entered, audits = 0, [], []
        for ways_in, leaves in zip(rows["audits"], rows["leaves"], strict=True):
            entered.append(state)
            audits.append(ways_in[state])
            state = int(leaves[state])
        out = rows.drop(columns=["audits", "leaves"]).astype({"conv_id": "Int64"})
        out["entered"], out["audit"] = entered, audits
        return out

    paths = durable(four.groupBy("conv_id").applyInPandas(chosen, f"{kept}, entered int, audit string"))
    turns = live.groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
    sums = paths.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("rows", "blank", "duplicate", "truncated")], (F.sum("illegal") + F.max("joints")).alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "block", "audit"))), lambda p: p["audit"]), "").alias("audit"),
    )
    everyone = narrow.select("conv_id").distinct()
    report = everyone.alias("e").join(sums.alias("s"), F.col("e.conv_id").eqNullSafe(F.col("s.conv_id")), "left").join(
        turns.alias("t"), F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")), "left",
    )
    zero = F.lit(0).cast("long")
    report = report.select(
        "e.conv_id", F.coalesce("s.rows", zero).alias("rows"), F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("t.n"), zero).alias("gaps"),
        *[F.coalesce(f"s.{c}", zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("s.audit", F.lit("")).alias("audit"),
    )

    def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a block follow their path, which is sorted before them."""
        names, out, size, letters, state = [*key, "messages"], [], 0, "", 0
        for batch in batches:
            for conv, piece, number, role, text, copies, entered, audit in zip(*[batch.column(i).to_pylist() for i in range(8)], strict=True):
                if audit is not None:
                    letters, state, used = audit, entered, 0
                    continue
                said = []
                for _ in range(copies):
                    # The letters up to the one that takes this row.
                    end = used
                    while letters[end] == "I":
                        end += 1
                    some, state = apply(letters[used:end + 1], state, iter([(role, text)]))
                    said, used = said + some, end + 1
                rest = letters[used:]
                if not rest.strip("I"):  # closing insertions
                    some, state = apply(rest, state, iter([]))
                    said, used = said + some, len(letters)
                if said:
                    out.append(dict(zip(names, (conv, piece, number, [{"role": r, "text": t} for r, t in said]), strict=True)))
                    size += len(text)
                if size > 8 << 20 or len(out) > 10_000:
                    yield pa.RecordBatch.from_pylist(out, parts_schema)
                    out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, parts_schema)

    parts_schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int32()), ("block", pa.int64()), ("messages", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
    none = F.lit(None)
    texts = loose.where("copies > 0").select(
        *["conv_id", "piece"], (F.col("at") / size).cast("long").alias("block"), "role", "text", "copies", none.cast("int").alias("entered"), none.cast("string").alias("audit"), "at",
    )
    heads = paths.select(*key, none.cast("string").alias("role"), none.cast("string").alias("text"), none.cast("int").alias("copies"), "entered", "audit", F.lit(-1).cast("long").alias("at"))
    stream = texts.unionByName(heads).repartition(*key).sortWithinPartitions(*key, "at").drop("at")
    return report, stream.mapInArrow(mended, f"conv_id long, piece int, block long, {_MESSAGES}").withColumn("place", F.monotonically_increasing_id())


def digests(report: DataFrame, parts: DataFrame) -> DataFrame:
    """``report`` with the digest of the repaired ``role:text`` lines."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, first, out = (), None, True, []
        for batch in batches:
            for conv, messages in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (conv,) != current:
                    if digest:
                        out.append((current[0], digest.hexdigest()))
                    current, digest, first = (conv,), hashlib.sha256(), True
                for m in messages:
                    digest.update(("" if first else "\n").encode() + f"{m['role']}:{m['text']}".encode("utf-8", "surrogatepass"))
                    first = False
        if digest:
            out.append((current[0], digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([h for _, h in out], pa.string())], names=["conv_id", "hash"])

    hashed = parts.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "block", "place").select("conv_id", "messages").mapInArrow(stream, "conv_id long, hash string")
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    both = report.alias("r").join(hashed.alias("h"), F.col("r.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
    return both.select("r.*", F.coalesce("hash", F.sha2(F.coalesce(lines, F.lit("")).cast("binary"), 256)).alias("repaired_sha256")).drop("messages")
