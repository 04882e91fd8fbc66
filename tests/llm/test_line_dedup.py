"""Line dedup against every earlier line compared one by one."""

import random

import pytest
from pyspark.sql import functions as F

from starfold.llm import line_dedup

DOCS = "doc_id long, text string, line_no int, _lines string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 7, "clash", len(t or "")) for i, t in rows], DOCS)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least=line_dedup.LEAST):
    lines = sorted((i, n, x) for i, t in rows if i is not None and t is not None for n, x in enumerate(t.split("\n")) if x.strip(" \t\x0b\x0c\r"))
    first = {}
    for i, n, x in lines:
        first.setdefault(x, (i, n))
    out = set()
    for i, n, x in lines:
        near = [p for y, p in first.items() if p < first[x] and min(len(x), len(y)) >= least and one_edit(x, y)]
        if near:
            out.add((i, n, *min(near), 1))
        elif (i, n) != first[x]:
            out.add((i, n, *first[x], 0))
    return out


def found(spark, rows):
    gone = line_dedup.dropped_lines(table(spark, rows))
    return {(r.doc_id, r.line_no, r.kept_doc_id, r.kept_line_no, r.edits) for r in gone.collect()}


def edited(draw, line):
    i, kind = draw.randrange(len(line)), draw.randrange(3)
    return line[:i] + ["", "é", line[i] + "x"][kind] + line[i + 1:]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    draw = random.Random(seed)
    lines = ["".join(draw.choices("ab cdé", k=draw.choice([5, 19, 20, 21, 31, 32, 33, 47, 48, 64, 200]))) for _ in range(40)]
    lines += ["-" * 40, "-" * 41, "page 1 of the whole book", "page 2 of the whole book", "page 12 of the whole book", "", "  ", "\t"]
    pool = lines + [edited(draw, x) for x in lines if x] + [edited(draw, edited(draw, x)) for x in lines if x]
    rows = [(i, "\n".join(draw.choices(pool, k=draw.randint(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, pool[0])]
    expected = plain(rows)
    assert any(e[-1] for e in expected)
    assert found(spark, rows) == expected


def test_very_long_line_and_hot_line(spark):
    long = "".join(random.Random(4).choices("abcdefgh ", k=60_000))
    hot = "the same line in very many documents"
    rows = [(1, long), (2, long[:30_000] + long[30_001:]), (3, long[:10] + "XY" + long[10:])] + [(i, hot) for i in range(10, 300)]
    assert found(spark, rows) == {(2, 0, 1, 0, 1)} | {(i, 0, 10, 0, 0) for i in range(11, 300)}


def test_documents_rebuilt(spark):
    rows = [
        (1, "kept line number one\n\nalso kept"), (2, "kept line number one\nnew\nkept line number onE"), (3, "kept line number one"),
        (4, None), (5, ""), (6, "\n"), (None, "kept line number one"), (3, "another text of document three"),
    ]
    out = line_dedup.dedup(table(spark, rows))
    assert out.columns == table(spark, rows).columns
    assert sorted(((r.doc_id or -1, r.text, r.n_chars, r.line_no, r._lines) for r in out.collect()), key=str) == sorted([
        (1, rows[0][1], len(rows[0][1]), 7, "clash"), (2, "new", 3, 7, "clash"), (4, None, 0, 7, "clash"), (5, "", 0, 7, "clash"), (6, "\n", 1, 7, "clash"),
        (-1, "kept line number one", 20, 7, "clash"), (3, rows[-1][1], len(rows[-1][1]), 7, "clash"),
    ], key=str)


def test_repeated_rows_share_a_fate(spark):
    rows = [(1, "one line of some length\nand one more of it"), (1, "one line of some length\nand one more of it"), (2, "one line of some length\nx")]
    assert sorted(r.text for r in line_dedup.dedup(table(spark, rows)).collect()) == sorted([rows[0][1], rows[0][1], "x"])


def test_empty_and_native(spark):
    gone = line_dedup.dropped_lines(table(spark, []))
    assert gone.collect() == [] and line_dedup.dedup(table(spark, [])).collect() == []
    plan = line_dedup.dedup(table(spark, [(1, "a")])).select(F.col("text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def one_word(a, b):
    a, b = sorted((a.split(" "), b.split(" ")), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_one_word_apart(spark):
    draw, share = random.Random(3), 1 / 16
    words = ["in", "to", "the", "thouen", "a", "reading", "of", "é"]
    lines = [" ".join(draw.choices(words, k=draw.choice([6, 7, 20, 41, 60]))) for _ in range(12)]
    for x in lines[:]:
        for n in (0, 1, 1):
            own = x.split(" ")
            i = draw.randrange(len(own))
            own[i:i + n] = draw.choices(words, k=draw.randrange(2))
            lines.append(" ".join(own))
    draw.shuffle(lines)
    first, expected = {}, {}
    for i, x in enumerate(lines):
        first.setdefault(x, i)
    for i, x in enumerate(lines):
        near = []
        for y, p in first.items():
            if p < first[x] and min(len(x), len(y)) >= line_dedup.LEAST:
                edits = distance(x, y)
                if edits <= 1 or (one_word(x, y) and edits <= max(2, int(len(x) * share))):
                    near.append((p, edits))
        if near:
            expected[i] = min(near)
        elif first[x] != i:
            expected[i] = first[x], 0
    gone = line_dedup.dropped_lines(table(spark, list(enumerate(lines))), share=share).collect()
    assert {r.doc_id: (r.kept_doc_id, r.edits) for r in gone} == expected
    assert sum(e > 1 for _, e in expected.values()) > 5
