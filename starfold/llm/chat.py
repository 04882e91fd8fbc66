"""Chat formatting from event logs, with DataFrame functions only.

A log has a row per event: a conversation, the position of a message in it, a
sequence number, a kind, a role and a text. Kinds:

- ``start``       opens the message with its role; text begins with the event's text
- ``delta``       appends its text
- ``edit``        replaces what the message said so far; later deltas append
- ``regenerate``  empties the message and withdraws every later message of the
                  conversation that was started before it

The state of a message is a fold over its events by sequence; it is computed as the
concatenation of the texts from its last resetting event on, so only that suffix is
gathered. A message is gathered by (conversation, message), a conversation only as
its finished, rendered blocks.

Template: ``<s>[INST]role[/INST]text</s>`` for each message, in order. Control
strings inside roles and texts get a backslash after their first character, and
those that already have backslashes there one more, which ``unescape`` takes away.

Defined cases: null text is empty, null role is empty, a null kind is a delta; a
message without a start event has the empty role; events with the same sequence
number are taken in the order start, edit, regenerate, delta, then by text; exact
repeats of an event count each (a log that repeats a delta said it twice); a null
conversation id is a conversation of its own; extra columns are ignored; an empty
log has no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
# Control strings of the template family, by their first character and rest.
_CONTROL = r"(/?s>|/?INST\]|</?SYS>>)"
_PLAIN, _ESCAPED = rf"([<\[])(\\*){_CONTROL}", rf"([<\[])\\(\\*){_CONTROL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def events_of_turns(turns: DataFrame, chars: int = 512) -> DataFrame:
    """The log a streaming server would have kept of finished ``turns`` (conv_id, turn,
    role, text): a start per turn and a delta per ``chars`` characters of its text.
    Rows of one conversation are ordered by turn, then role, then text."""
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("message", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")))
    steps = F.sequence(F.lit(0), F.ceil(F.length("text") / F.lit(chars)).cast("int"))
    return rows.select("conv_id", "message", "role", "text", F.explode(steps).alias("seq")).select(
        "conv_id", F.col("message").cast("long"), F.col("seq").cast("long"),
        F.when(F.col("seq") == 0, "start").otherwise("delta").alias("kind"), "role",
        F.when(F.col("seq") == 0, "").otherwise(F.substring("text", (F.col("seq") - 1) * chars + 1, F.lit(chars))).alias("text"),
    )


def messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log of events."""
    kind = F.coalesce(F.col("kind"), F.lit("delta"))
    rank = F.when(kind == "start", 0).when(kind == "edit", 1).when(kind == "regenerate", 2).otherwise(3)
    log = events.select(
        "conv_id", "message", F.struct(F.col("seq").cast("long").alias("seq"), rank.alias("rank")).alias("at"), kind.alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    of_message = Window.partitionBy("conv_id", "message")
    reset = F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(of_message)
    live = log.withColumn("reset", reset).where(F.col("reset").isNull() | (F.col("at") >= F.col("reset")) | (F.col("kind") == "start") | (F.col("kind") == "regenerate"))
    said = F.when((F.col("kind") != "regenerate") & (F.col("reset").isNull() | (F.col("at") >= F.col("reset"))), F.struct("at", "text"))
    folded = live.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(said)).alias("parts"),
        F.max(F.when(F.col("kind") == "start", F.struct("at", "role"))).alias("opened"),
        F.min("at.seq").alias("began"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("at.seq"))).alias("redone"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    began = F.coalesce("opened.at.seq", "began")
    standing = folded.withColumn("withdrawn", F.max("redone").over(before)).where(F.col("withdrawn").isNull() | (began >= F.col("withdrawn")))
    return standing.select(
        "conv_id", "message", F.coalesce("opened.role", F.lit("")).alias("role"), F.array_join("parts.text", "").alias("text"),
    )


def render(finished: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted`` text, and ``loss_mask``, the stretches
    to learn from as (block, start, chars): the block of the turn counted from 0 and the
    first character in it counted from 1."""
    block = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE), escape(F.col("text")), F.lit(CLOSE))
    start = F.length(escape(F.col("role"))) + F.lit(len(OPEN) + len(MIDDLE) + 1)
    turns = finished.select("conv_id", F.struct(
        "message", block.alias("block"), (F.col("role") == learn).alias("learn"), start.alias("start"), F.length(escape(F.col("text"))).alias("chars"),
    ).alias("turn")).groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    mask = F.filter(
        F.transform("turns", lambda t, i: F.struct(i.alias("block"), t["start"].alias("start"), t["chars"].alias("chars"), t["learn"].alias("learn"))),
        lambda m: m["learn"],
    )
    return turns.select(
        "conv_id", F.array_join("turns.block", "").alias("formatted"),
        F.transform(mask, lambda m: F.struct(m["block"], m["start"], m["chars"])).alias("loss_mask"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Turns and learnt texts out of formatted text alone: ``turns`` as (role, text)
    and ``learnt`` as texts, both unescaped."""
    blocks = F.filter(F.split("formatted", CLOSE, -1), lambda b: b != "")

    def turn(b: Column) -> Column:
        middle = F.locate(MIDDLE, b) if isinstance(b, str) else F.instr(b, MIDDLE)
        return F.struct(
            unescape(F.substring(b, F.lit(len(OPEN) + 1), middle - F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substring(b, middle + F.lit(len(MIDDLE)), F.length(b))).alias("text"),
        )

    split = rendered.withColumn("blocks", blocks)
    return split.select(
        *[c for c in rendered.columns], F.transform("blocks", turn).alias("turns"),
        F.transform("loss_mask", lambda m: unescape(F.substring(F.get("blocks", m["block"]), m["start"], m["chars"]))).alias("learnt"),
    )


def digests(read: DataFrame) -> DataFrame:
    """What was read back, in digest form."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
