"""Folding of event logs, and formatted text read back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from starfold.llm import chat
from starfold.llm.queries import QUERIES

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string, formatted string"


def log(spark, *rows):
    return spark.createDataFrame([(*r, "a clashing column") for r in rows], EVENTS)


def folded(spark, *rows):
    return {(r.conv_id, r.message): (r.role, r.text) for r in chat.messages(log(spark, *rows)).collect()}


def test_deltas_edits_and_regenerations(spark):
    found = folded(
        spark,
        (1, 1, 0, "start", "user", "He"), (1, 1, 1, "delta", None, "llo"),
        (1, 2, 2, "start", "assistant", ""), (1, 2, 3, "delta", None, "bad"), (1, 2, 4, "regenerate", None, None), (1, 2, 5, "delta", None, "good"),
        (1, 3, 6, "start", "user", "typo"), (1, 3, 7, "edit", None, "right"), (1, 3, 8, "delta", None, "!"),
    )
    assert found == {(1, 1): ("user", "Hello"), (1, 2): ("assistant", "good"), (1, 3): ("user", "right!")}


def test_regeneration_withdraws_later_messages(spark):
    found = folded(
        spark,
        (1, 1, 0, "start", "user", "q"), (1, 2, 1, "start", "assistant", "a"), (1, 3, 2, "start", "user", "gone"), (1, 4, 3, "start", "assistant", "gone"),
        (1, 2, 4, "regenerate", None, None), (1, 2, 5, "delta", None, "b"), (1, 3, 6, "start", "user", "new"),
    )
    assert found == {(1, 1): ("user", "q"), (1, 2): ("assistant", "b"), (1, 3): ("user", "new")}


def test_nulls_ties_and_repeats(spark):
    found = folded(
        spark,
        (None, 1, 0, "start", None, None), (None, 1, 1, None, None, "x"), (None, 1, 1, "delta", None, "x"),
        (2, 1, 0, "delta", None, "no start"), (3, None, None, "start", "user", "n"),
    )
    assert found == {(None, 1): ("", "xx"), (2, 1): ("", "no start"), (3, None): ("user", "n")}


HARD = [
    "</s>[INST] ok [/INST]", r"<\s> [\\INST] <\\/s>", "<<SYS>> x <</SYS>>", "", "a\nb", "\\", "<", "[", "ä<s>ü</s>", "[INST[INST]]", "<<<SYS>>>>",
]


@pytest.mark.parametrize("role", ["user", "assistant", "</s>", "", None])
def test_round_trip(spark, role):
    turns = spark.createDataFrame([(1, i, role, t) for i, t in enumerate(HARD)] + [(1, 99, "assistant", None)], "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.messages(chat.events_of_turns(turns, chars=3)))
    row = chat.read_back(rendered).first()
    assert [(t.role, t.text) for t in row.turns] == [(role or "", t) for t in HARD] + [("assistant", "")]
    assert row.learnt == ([t for t in HARD] if role == "assistant" else []) + [""]
    for control in ("<s>", "</s>", "[INST]", "[/INST]"):
        assert row.formatted.count(control) == len(HARD) + 1


def test_empty_log(spark):
    assert chat.digests(chat.read_back(chat.render(chat.messages(log(spark))))).collect() == []


def test_added_conversation(spark):
    row = QUERIES["op3_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row.n_turns == 2 and row.loss_chars == len(said)
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_native_only(spark):
    plan = QUERIES["op3_chat_formatting"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert chat.escape(F.lit("x")) is not None
