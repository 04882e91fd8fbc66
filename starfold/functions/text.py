"""Cleansing of scalars (X1-X25): ``Column -> Column``, all inside the JVM.

Nothing here raises on bad input: ANSI casts are always the ``try_`` kind.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import DOI_URL_PREFIX, ID_URL_PREFIX, WHITE_SPACE

# Runs of white space other than one plain space, which may stay as it is.  Java's
# Unicode class lacks the four separators 1c-1f.
_ID_PREFIX = "^" + ID_URL_PREFIX.replace(".", r"\.")
_ANY_SPACE = r"[\s\x1c-\x1f]*"
_SPACES = r"(?U)[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*| [\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """Remove white space, Unicode's included, from both ends."""
    return F.trim(c, F.lit(WHITE_SPACE))


def only_group(c: Column, pattern: str) -> Column:
    """The group of a pattern, null without a match.

    Mentions ``c`` once: inside lambdas Spark shares nothing, so an expression
    mentioned twice is computed twice.
    """
    return F.get(F.regexp_extract_all(c, F.lit(pattern), 1), 0)


def filled(c: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """the first value that is neither null nor empty."""
    return F.coalesce(*[filled(c) for c in cs])


def first_filled_array(*cs: Column) -> Column:
    """F7 for arrays: the first that has elements."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in cs])


def spaced_once(c: Column) -> Column:
    """X16 for lists that drop empty texts anyway: blank becomes empty."""
    return F.trim(F.regexp_replace(c, _SPACES, " "))


def collapse_spaces(c: Column) -> Column:
    """Every run of white space becomes one space; blank becomes null."""
    return filled(spaced_once(c))


# Casting a text that is no number raises and catches inside Spark, at twenty
# times the cost of a cast that works; these patterns keep such texts away.
_WHOLE = f"(?U)^{_ANY_SPACE}([+-]?[0-9]+){_ANY_SPACE}$"
_DECIMAL = (
    rf"(?iU)^{_ANY_SPACE}([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|inf(?:inity)?)){_ANY_SPACE}$"
)
_DATE = "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_TIME = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,6})?"


def whole_number(c: Column) -> Column:
    """X6 on text: integer or null; ``'12.7'`` is null."""
    return only_group(c, _WHOLE).try_cast("bigint")


def whole_of_number(c: Column) -> Column:
    """X6 on numbers: 12.7 is 12."""
    return c.try_cast("bigint")


def _json_text(c: Column) -> Column:
    return F.try_variant_get(c, "$", "string")


def _json_number(c: Column) -> Column:
    return F.try_variant_get(c, "$", "double")


def _is_json_text(c: Column) -> Column:
    return F.to_json(c).startswith('"')


def whole_of_json(c: Column) -> Column:
    """X6 on a JSON scalar: the number 12.7 is 12, the text ``"12.7"`` is null."""
    return F.coalesce(whole_number(_json_text(c)), F.when(~_is_json_text(c), whole_of_number(_json_number(c))))


def flag_of_json(c: Column) -> Column:
    """X10 on a JSON scalar: numbers by being zero, texts by their word."""
    return F.when(_is_json_text(c), flag(_json_text(c))).otherwise(flag_of_number(_json_number(c)))


def decimal_number(c: Column) -> Column:
    """X7."""
    return only_group(c, _DECIMAL).try_cast("double")


# The words that stand for yes and no.
_YES = ("true", "t", "1", "yes", "y")
_NO = ("false", "f", "0", "no", "n")


def flag(c: Column) -> Column:
    """X10 on text: ten words in any case, anything else is null."""
    word = F.lower(strip(c))
    return F.when(word.isin(*_YES), F.lit(True)).when(word.isin(*_NO), F.lit(False))


def flag_of_number(c: Column) -> Column:
    """X10 on numbers."""
    return c != 0


def short_id(c: Column) -> Column:
    """The id without its address prefix."""
    return filled(F.regexp_replace(strip(c), _ID_PREFIX, ""))


def id_number(c: Column) -> Column:
    """The digits that end a short id; a tail that is no number gives null."""
    # The address prefix has no digits, so it need not be removed first.
    return only_group(c, f"(?U)^[^0-9]*([0-9]+){_ANY_SPACE}$").try_cast("bigint")


def map_text(m: Column, key: str) -> Column:
    """Null-safe lookup in a map of texts."""
    return filled(strip(F.try_element_at(m, F.lit(key))))


def iso_date_text(c: Column) -> Column:
    """``YYYY-MM-DD`` for the three accepted formats, else the text as it is."""
    timed, dated = c.rlike(f"^{_DATE}T{_TIME}$"), c.rlike(f"^{_DATE}$")
    fraction = "".join(f"[.{'S' * n}]" for n in range(6, 0, -1))
    day = F.when(timed, F.try_to_timestamp(c, F.lit(f"yyyy-M-d'T'H:m:s{fraction}"))).when(
        dated, F.try_to_timestamp(c, F.lit("yyyy-M-d"))
    )
    return filled(F.coalesce(F.date_format(day, "yyyy-MM-dd"), c))


def iso_day_text(c: Column) -> Column:
    """The first ten characters of X4."""
    return F.substring(iso_date_text(c), 1, 10)


def day(c: Column) -> Column:
    """X4/X5 as a date column: the leading calendar day, null when there is none."""
    return filled(F.regexp_extract(c, f"^{_DATE}(?![0-9])", 0)).try_cast("date")


def longest_number(c: Column) -> Column:
    """The text as a number, else its longest run of digits (the last on ties)."""
    runs = F.transform(
        F.regexp_extract_all(c, F.lit("([0-9]+)"), 1),
        lambda run, i: F.struct(F.length(run).alias("n"), i.alias("i"), run.alias("run")),
    )
    return F.coalesce(whole_number(c), F.array_max(runs)["run"].try_cast("bigint"))


def language_code(c: Column) -> Column:
    """X9."""
    return filled(F.lower(F.substring(c, 1, 2)))


def last_segment(c: Column) -> Column:
    """What follows the last slash, trailing slashes ignored."""
    return filled(F.substring_index(F.rtrim(strip(c), F.lit("/")), "/", -1))


def segment_number(c: Column) -> Column:
    """The last path segment as an integer."""
    return whole_number(F.substring_index(F.rtrim(strip(c), F.lit("/")), "/", -1))


def orcid(c: Column) -> Column:
    """Sixteen characters in four dashed groups, found in three ways."""
    s = strip(c)
    dashed = F.regexp_extract(s, "(?i)[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]", 0)
    compact = F.regexp_extract(s, r"(?i)\b[0-9]{15}[0-9X]\b", 0)
    scattered = F.regexp_extract(F.regexp_replace(s, "[^0-9Xx]", ""), "(?i)^[0-9]{15}[0-9X]$", 0)
    found = F.upper(F.regexp_replace(first_filled(dashed, compact, scattered), "-", ""))
    return F.regexp_replace(found, "^(.{4})(.{4})(.{4})(.{4})$", "$1-$2-$3-$4")


def scopus_author(c: Column) -> Column:
    """X13."""
    s = strip(c)
    return first_filled(
        F.regexp_extract(s, "(?i)authorid=([0-9]+)", 1), F.regexp_extract(s, "^[0-9]+$", 0)
    ).try_cast("bigint")


def doi(c: Column) -> Column:
    """Without the secure resolver prefix; other prefixes and case are kept."""
    s = strip(c)
    n = len(DOI_URL_PREFIX)
    has_prefix = F.lower(F.substring(s, 1, n)) == DOI_URL_PREFIX
    return filled(F.when(has_prefix, F.substring(s, F.lit(n + 1), F.length(s))).otherwise(s))


def issn(c: Column) -> Column:
    """X17."""
    tail = F.upper(F.substring_index(strip(c), ":", -1))
    return filled(F.regexp_extract(tail, "[0-9]{4}-[0-9]{3}[0-9X]", 0))


def id_with_letter(c: Column, letter: str) -> Column:
    """The id number when the short id starts with ``letter``."""
    return F.when(short_id(c).startswith(letter), id_number(c))


def page_range(first: Column, last: Column) -> Column:
    """X23."""
    return F.when(filled(last).isNull(), filled(first)).otherwise(F.concat(filled(first), F.lit("-"), last))


def is_object(c: Column) -> Column:
    return c.startswith("{")


def object_field(c: Column, name: str) -> Column:
    """A field of an element read as text; null unless the element is an object."""
    return F.when(is_object(c), F.get_json_object(c, f"$.{name}"))


def object_value(c: Column, name: str) -> Column:
    """A field of an element read as text, as a JSON scalar that is still a number or a
    text; null unless the element is an object."""
    return F.when(is_object(c), F.try_variant_get(F.try_parse_json(c), f"$.{name}", "variant"))


def element_id(c: Column) -> Column:
    """The id of an element that is an object or the id itself."""
    return F.when(is_object(c), F.get_json_object(c, "$.id")).otherwise(c)


def canonical_object(c: Column) -> Column:
    """JSON with its keys sorted, so that equal objects have equal text."""
    return F.to_json(F.try_parse_json(c))


def affiliation_texts(many: Column, one: Column) -> Column:
    """The cleaned list; when that is empty, the single text split at ``;``."""
    def clean(texts: Column) -> Column:
        return F.filter(F.transform(texts, spaced_once), lambda t: t.isNotNull() & (t != ""))

    listed = clean(F.coalesce(many, F.array().cast("array<string>")))
    parts = clean(F.split(F.coalesce(one, F.lit("")), ";"))
    return F.get(
        F.transform(F.array(listed), lambda own: F.when(F.size(own) > 0, own).otherwise(parts)), 0
    )
