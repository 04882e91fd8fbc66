"""Line dedup over a whole corpus by a deletion-neighbourhood join, with DataFrame
functions only.

A line goes when an earlier line of the corpus (by document id, then line number) is
equal to it, or differs by one edit (a character put in, left out or replaced) and both
have at least ``least`` characters; that the earlier line may go too does not matter.
Lines without a word are left alone. With ``share``, it also goes when it differs from an
earlier one by one word (put in, left out or replaced) and by at most that share of its
characters as edits, two at least.

Two lines are one edit apart exactly if leaving out one character makes them equal:
from both at the same place (replaced), or from the longer one only (put in). Every
line therefore emits its deletion variants as hashed keys, tagged by the place where
the character was left out of a line of the same length, and groups of equal keys hold
only lines within the bound: the earliest of a group is found by a partial minimum, not
by forming its pairs, and each member's edit distance to it is verified on the texts.

So that not every character of the corpus becomes a key, variants are emitted only
where an equal one can exist. One edit leaves a half of the line as it was, and seven
of its eighths; a line goes on if another line agrees with it on a half (key: hash of
the half, for a range of lengths), then on all but one eighth (key: hash of the rest,
for the length), and only the remaining eighth is varied. Both tests can only let
too much through, never too little.

One word is looked for in the same way with words as the units: lines that share a half of
their words with another line (``word_halves``) emit themselves without one word, hashed
(``word_variants``), and the edit distance is verified on the texts.

Defined cases: null text and null ids take no part and stay as they are; rows that
repeat an id and text keep and lose the same lines; texts that share an id but differ
are told apart by their hash; the longest line is handled like any other, one key per
character of an eighth; extra columns are kept, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.session import durable

LEAST, WIDTH, PARTS = 20, 16, 8
WORD = r"[^\x20\x09-\x0D]"
_LINE, _PLACE = ["h1", "h2"], ["doc_id", "version", "line_no"]


def lines_of(docs: DataFrame) -> DataFrame:
    """Every line with a word: its place, text, two hashes and length."""
    split = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    return split.where(F.col("line").rlike(WORD)).select(
        *_PLACE, "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.length("line").alias("n")
    )


def half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and the last half, for the range of lengths the line is in; a
    line at the start of its range also has those of the range before."""

    def of(base: Column) -> list[Column]:
        half = F.floor(base / 2).cast("int")
        return [
            F.xxhash64(base, F.lit(0), F.substring(line, F.lit(1), half)),
            F.xxhash64(base, F.lit(1), F.substring(line, n - (base - half) + 1, base - half)),
        ]

    base = n - n % WIDTH
    own, before = of(base), of(base - WIDTH)
    return F.when(n % WIDTH == 0, F.array(*own, *before)).otherwise(F.array(*own))


def eighth_keys(line: Column, n: Column, parts: int = PARTS) -> Column:
    """(key, longer, middle) for each part: the hash of the rest of the line, and the
    part itself. A line stands for its own length and, as the longer one of a pair, for
    the length below, where its part is a character longer."""
    out = []
    for longer in (0, 1):
        size = n - longer
        for j in range(parts):
            low, high = F.floor(size * j / parts).cast("int"), F.floor(size * (j + 1) / parts).cast("int")
            rest = F.xxhash64(F.lit(j), size, F.substring(line, F.lit(1), low), F.substring(line, high + 1 + longer, n))
            out.append(F.struct(rest.alias("key"), F.lit(longer).alias("longer"), F.substring(line, low + 1, high - low + longer).alias("middle")))
    return F.array(*out)


def shared(keys: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose key another line has too."""
    several = keys.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("key")
    return keys.join(several, "key")


def variants(keyed: DataFrame) -> DataFrame:
    """Deletion variants of the middles, hashed with the key of the rest: the role says
    whether the line is the shorter one as it is (0), the longer one with a character
    left out (1), or one of equal length with the character at a place left out (2)."""
    middle, n = F.col("middle"), F.length("middle")

    def without(i: Column) -> Column:
        return F.concat(F.substring(middle, F.lit(1), i - 1), F.substring(middle, i + 1, n))

    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    left_out = F.transform(places, lambda i: F.struct(
        F.xxhash64("key", F.when(F.col("longer") == 1, 0).otherwise(i), without(i)).alias("variant"),
        F.when(F.col("longer") == 1, 1).otherwise(2).alias("role"),
    ))
    whole = F.when(F.col("longer") == 0, F.array(F.struct(F.xxhash64("key", F.lit(0), middle).alias("variant"), F.lit(0).alias("role"))))
    emitted = F.explode(F.concat(F.coalesce(whole, F.array().cast("array<struct<variant:bigint,role:int>>")), left_out))
    return keyed.select("place", emitted.alias("e")).select("place", "e.variant", "e.role")


def word_halves(line: Column) -> Column:
    """Hashes of the first and the last half of the words, for their number and, as the
    longer one of a pair, for the number below."""
    words = F.split(line, " ", -1)
    n, out = F.size(words), []
    for longer in (0, 1):
        size = n - longer
        half = F.floor(size / 2).cast("int")
        out.append(F.xxhash64(size, F.lit(0), F.slice(words, F.lit(1), half)))
        out.append(F.xxhash64(size, F.lit(1), F.slice(words, n - (size - half) + 1, size - half)))
    return F.array_distinct(F.array(*out))


def word_variants(lines: DataFrame) -> DataFrame:
    """``lines`` (place, line) without one word each, in the roles of ``variants``."""
    words = F.split("line", " ", -1)
    n = F.size(words)

    def hashed(tag: Column, size: Column, left: Column, role: int) -> Column:
        return F.struct(F.xxhash64(tag, size, left).alias("variant"), F.lit(role).alias("role"))

    def without(i: Column) -> Column:
        return F.concat(F.slice(words, F.lit(1), i - 1), F.slice(words, i + 1, n))

    places = F.sequence(F.lit(1), n)
    every = F.concat(
        F.array(hashed(F.lit(0), n, words, 0)), F.transform(places, lambda i: hashed(F.lit(0), n - 1, without(i), 1)),
        F.transform(places, lambda i: hashed(i, n, without(i), 2)),
    )
    return lines.select("place", F.explode(every).alias("e")).select("place", "e.variant", "e.role").distinct()


def candidates(varied: DataFrame) -> DataFrame:
    """Places and the earliest one with which they share a variant, in fitting roles."""
    groups = varied.groupBy("variant").agg(
        F.min(F.when(F.col("role") != 1, F.col("place"))).alias("anchor"), F.min(F.when(F.col("role") == 1, F.col("place"))).alias("longer"),
        F.min("place").alias("low"), F.max("place").alias("high"),
    ).where("low <> high").select("variant", "anchor", "longer")
    earlier = F.when(F.col("role") == 0, F.col("longer")).otherwise(F.col("anchor"))
    return varied.join(groups, "variant").select("place", earlier.alias("kept")).where("kept < place").distinct()


def near_by_word(found: DataFrame, firsts: DataFrame, least: int, share: float) -> DataFrame:
    """Lines that differ by one word from an earlier one, that one and the edits."""
    long = found.where(F.col("n") >= least)
    halves = long.select(*_LINE, F.explode(word_halves(F.col("line"))).alias("key"))
    likely = shared(halves).select(*_LINE).distinct().join(firsts, _LINE).select(*_LINE, "place.*")
    texts = durable(long.join(likely, [*_LINE, *_PLACE]).select(F.struct(*_PLACE).alias("place"), *_LINE, "n", "line").dropDuplicates(_LINE))
    pairs = candidates(durable(word_variants(texts)))
    pairs = pairs.join(texts, "place").join(texts.select(F.col("place").alias("kept"), F.col("line").alias("other")), "kept")
    bound = f"cast(greatest(2, floor(n * {share!r}D)) as int)"
    edits = F.expr(f"levenshtein(line, other, {bound})")
    return pairs.select(*_LINE, F.struct("kept", edits.alias("edits")).alias("near")).where("near.edits >= 0")


def dropped_lines(docs: DataFrame, least: int = LEAST, share: float = 0.0) -> DataFrame:
    """A row for every line that goes: its place (doc_id, version, line_no), the place of
    the earliest line it repeats (kept_doc_id, kept_line_no) and the edits between them."""
    docs = docs.select("doc_id", "text")
    found = lines_of(docs)
    places = durable(found.select(*_PLACE, *_LINE, "n", F.when(F.col("n") >= least, half_keys(F.col("line"), F.col("n"))).alias("keys")))
    firsts = durable(places.groupBy(*_LINE).agg(F.min(F.struct(*_PLACE)).alias("place")))

    halves = places.where("keys is not null").select(*_LINE, F.explode("keys").alias("key"))
    likely = shared(halves).select(*_LINE).distinct().join(firsts, _LINE).select(*_LINE, "place.*")
    texts = durable(found.join(likely, [*_LINE, *_PLACE]).select(F.struct(*_PLACE).alias("place"), "h1", "h2", "n", "line").dropDuplicates(["h1", "h2"]))

    eighths = texts.select("place", "h1", F.explode(eighth_keys(F.col("line"), F.col("n"))).alias("e")).select("place", "h1", "e.*")
    varied = durable(variants(shared(eighths)).distinct())
    pairs = candidates(varied)
    read = texts.select("place", "h1", "h2", "line")
    pairs = pairs.join(read, "place").join(read.select(F.col("place").alias("kept"), F.col("line").alias("other")), "kept")
    near = pairs.where(F.levenshtein("line", "other", 1).between(0, 1)).select(*_LINE, F.struct("kept", F.lit(1).alias("edits")).alias("near"))
    if share:
        near = near.unionByName(near_by_word(found, firsts, least, share))
    near = near.groupBy(*_LINE).agg(F.min("near").alias("near")).select(*_LINE, "near.kept", "near.edits").withColumnRenamed("kept", "near")

    all_lines = places.select(*_PLACE, *_LINE).join(firsts, _LINE).join(near, _LINE, "left")
    kept = F.coalesce("near", "place")
    return all_lines.where(F.col("near").isNotNull() | (F.struct(*_PLACE) != F.col("place"))).select(
        *_PLACE, kept["doc_id"].alias("kept_doc_id"), kept["line_no"].alias("kept_line_no"), F.coalesce("edits", F.lit(0)).alias("edits"),
    )


def dedup(docs: DataFrame, least: int = LEAST, share: float = 0.0) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the lines that go. A
    document that had words and loses every line with one goes too; ``n_chars`` is
    brought up to date where it exists."""
    gone = dropped_lines(docs, least, share).groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("_gone")).toDF("_id", "_version", "_gone")
    # the row travels without its text, which the lines hold
    row = F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in docs.columns])
    rows = docs.select(row.alias("_row"), F.split("text", "\n", -1).alias("_lines"), F.xxhash64("text").alias("_hash"))
    on = (F.col("_row.doc_id") == F.col("_id")) & (F.col("_hash") == F.col("_version"))
    joined = rows.join(gone, on, "left")
    every = F.when(F.size("_lines") > 0, F.sequence(F.lit(0), F.size("_lines") - 1))
    left = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.transform(F.array_except(every, "_gone"), lambda i: F.get("_lines", i)))
    joined = joined.withColumn("_left", left)
    joined = joined.where(F.col("_gone").isNull() | F.exists("_left", lambda line: line.rlike(WORD)))
    text = F.array_join("_left", "\n")
    new = {"text": text, **({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})}
    return joined.select(*[
        (F.when(F.col("_left").isNotNull(), new[c]).otherwise(F.col("_row")[c]) if c in new else F.col("_row")[c]).alias(c) for c in docs.columns
    ])
