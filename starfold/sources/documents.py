"""Entity documents: the shape read from JSON, and the step from text to rows.

Scalars are read as text, so a number where text was expected (or the reverse)
never spoils a document; the operators cast.  Elements that may be an object or
an id stay JSON text; locations, which are compared as a whole, are variants.

A document is read in two steps.  Reading by its shape, in one go, does for all
documents that have it.  Those with a field of another type (``[]`` for an empty
object, ``false`` or ``{}`` for a text) are read again value by value: a field of
another type is absent there, at any depth, and everything else is kept.  Only a
line that is no JSON object is malformed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.arrays import let

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)
TEXT_MAP = T.MapType(TEXT, TEXT)


def _fields(names: str, **nested: T.DataType) -> T.StructType:
    fields = [T.StructField(n, TEXT) for n in names.split()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


def _scalars(names: str) -> dict[str, T.DataType]:
    """Fields whose JSON type matters: a number there is not the same as its text."""
    return dict.fromkeys(names.split(), T.VariantType())


def _list(names: str, **nested: T.DataType) -> T.ArrayType:
    return T.ArrayType(_fields(names, **nested))


_DATED = "id display_name updated_date created_date "
_PICTURED = _DATED + "image_url image_thumbnail_url "

_APC = _fields("provenance currency", **_scalars("value value_usd"))
_ROOT_LINK = _fields("id")
_TOPIC_IDS = _fields("wikidata wikipedia")

DOCUMENTS: dict[str, T.StructType] = {
    "works": _fields(
        _DATED + "type type_crossref title doi doi_registration_agency publication_date "
        "language fulltext_origin",
        # Compared as a whole, and read by several tables: parsed once, when staged.
        **_scalars("primary_location best_oa_location"),
        **_scalars("publication_year is_paratext is_retracted referenced_works_count cited_by_count"),
        ids=_fields("doi pmid pmcid arxiv", **_scalars("mag")),
        biblio=_fields("volume issue first_page last_page"),
        open_access=_fields("oa_status oa_url", **_scalars("is_oa any_repository_has_fulltext")),
        apc_list=_APC,
        apc_paid=_APC,
        locations=T.ArrayType(T.VariantType()),
        abstract_inverted_index=T.MapType(TEXT, T.ArrayType(T.IntegerType())),
        concepts=_list("id score"),
        topics=_list("id score"),
        sustainable_development_goals=_list("id display_name score"),
        keywords=_list("keyword display_name score"),
        mesh=_list("descriptor_ui descriptor_name qualifier_ui qualifier_name", **_scalars("is_major_topic")),
        authorships=_list(
            "raw_author_name author_position raw_affiliation_string",
            **_scalars("is_corresponding"),
            author=_fields("id display_name"),
            countries=TEXTS,
            raw_affiliation_strings=TEXTS,
            affiliations=_list("raw_affiliation_string", institution_ids=TEXTS),
            institutions=_list("id display_name"),
        ),
        grants=_list("funder award_id"),
        referenced_works=TEXTS,
        related_works=TEXTS,
    ),
    "authors": _fields(
        _DATED + "orcid last_known_institution last_known_institutions",
        ids=_fields("orcid scopus wikipedia"),
        display_name_alternatives=TEXTS,
        affiliations=TEXTS,
    ),
    "institutions": _fields(
        _PICTURED + "type country_code homepage_url ror",
        **_scalars("is_super_system"),
        geo=_fields("region city country latitude longitude", **_scalars("geonames_city_id")),
        ids=_fields("wikipedia wikidata grid", **_scalars("mag")),
        display_name_acronyms=TEXTS,
        display_name_alternatives=TEXTS,
        international=_fields("", display_name=TEXT_MAP),
        associated_institutions=TEXTS,
        roles=TEXTS,
        repositories=TEXTS,
        lineage=TEXTS,
    ),
    "concepts": _fields(
        _PICTURED + "description wikidata",
        **_scalars("level"),
        ids=_fields("wikidata wikipedia", **_scalars("mag"), umls_cui=TEXTS, umls_aui=TEXTS),
        ancestors=TEXTS,
        related_concepts=TEXTS,
        international=_fields("", display_name=TEXT_MAP, description=TEXT_MAP),
    ),
    "sources": _fields(
        _DATED + "abbreviated_title type country_code host_organization publisher_id "
        "homepage_url issn_l",
        **_scalars("is_in_doaj is_oa apc_usd"),
        ids=_fields("wikidata fatcat issn_l", **_scalars("mag"), issn=TEXTS),
        alternate_titles=TEXTS,
        issn=TEXTS,
        apc_prices=TEXTS,
        societies=TEXTS,
    ),
    "funders": _fields(
        _PICTURED + "country_code description homepage_url ror",
        ids=_fields("wikidata wikipedia ror"),
        alternate_titles=TEXTS,
        roles=TEXTS,
    ),
    "publishers": _fields(
        _PICTURED + "homepage_url parent_publisher",
        **_scalars("hierarchy_level"),
        ids=_fields("wikidata wikipedia ror"),
        alternate_titles=TEXTS,
        country_codes=TEXTS,
    ),
    "domains": _fields(
        _DATED + "description", ids=_TOPIC_IDS, siblings=TEXTS,
        display_name_alternatives=TEXTS, fields=TEXTS,
    ),
    "fields": _fields(
        _DATED + "description", ids=_TOPIC_IDS, siblings=TEXTS,
        display_name_alternatives=TEXTS, subfields=TEXTS, domain=_ROOT_LINK,
    ),
    "subfields": _fields(
        _DATED + "description", ids=_TOPIC_IDS, siblings=TEXTS,
        display_name_alternatives=TEXTS, topics=TEXTS, domain=_ROOT_LINK, field=_ROOT_LINK,
    ),
    "topics": _fields(
        _DATED + "description", ids=_TOPIC_IDS, siblings=TEXTS, keywords=TEXTS,
        domain=_ROOT_LINK, field=_ROOT_LINK, subfield=_ROOT_LINK,
    ),
}

_BAD = "_malformed"
# Fields that are compared or read as JSON text; lists of texts keep objects that way too.
_AS_JSON = {"last_known_institution", "last_known_institutions"}
# What a field of another type looks like once it is text.
_NOT_TEXT = ("[]", "{}", "true", "false")


def _texts(c: Column, shape: T.StructType, listed: bool = False) -> Iterator[Column]:
    """The texts of a document, as lists where they stand in lists."""
    for f in shape:
        inner = c[f.name]
        if isinstance(f.dataType, T.StructType):
            yield from _texts(inner, f.dataType, listed)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            yield from _texts(F.flatten(inner) if listed else inner, f.dataType.elementType, True)
        elif isinstance(f.dataType, T.StringType) and f.name not in _AS_JSON:
            yield inner if listed else F.array(inner)


def _value(v: Column, kind: T.DataType, path: str, as_json: bool = False) -> Column:
    """A variant, found at ``path`` of the line, read as ``kind``; null where it is something else."""
    if isinstance(kind, T.VariantType):
        return v
    if isinstance(kind, T.StructType):
        inside = [
            _value(F.try_variant_get(v, f"$.{f.name}", "variant"), f.dataType, f"{path}.{f.name}", f.name in _AS_JSON).alias(f.name) for f in kind
        ]
        return F.when(F.to_json(v).startswith("{"), F.struct(*inside))
    if isinstance(kind, T.ArrayType):
        # Elements of a list of texts may be objects, which stay JSON text.
        return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda e: _value(e, kind.elementType, path, True))
    if isinstance(kind, T.MapType):
        # A variant sorts its keys; the order of a map's entries counts, so they come from the line.
        raw = F.get_json_object("value", path)
        entries = F.when(raw.startswith("{"), F.from_json(raw, "map<string,variant>"))
        return F.transform_values(entries, lambda _, e: _value(e, kind.valueType, path))
    if not isinstance(kind, T.StringType):
        return F.try_variant_get(v, "$", kind.simpleString())
    text = F.try_variant_get(v, "$", "string")
    return let(F.to_json(v), lambda j: F.when(j.rlike("^[{\\[]"), j if as_json else None).when(~j.isin("true", "false"), text))


def _parse(lines: DataFrame, entity: str, good: bool) -> DataFrame:
    """Well-formed (or the other) lines with their document in ``doc``.

    The parsed document goes through a generator that yields it once or not at
    all.  Written as a filter, Spark would push the test below the projection
    and parse each line once per use.
    """
    # Always the whole shape: what a document holds must not depend on what is read.
    shape = DOCUMENTS[entity]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "allowSingleQuotes": "false"}
    read = F.from_json("value", T.StructType([*shape, T.StructField(_BAD, TEXT)]), options)

    def has_shape(doc: Column) -> Column:
        lists = F.array(*_texts(doc, shape))
        other = F.exists(lists, lambda texts: F.coalesce(F.exists(texts, lambda t: F.coalesce(t.isin(*_NOT_TEXT), F.lit(False))), F.lit(False)))
        # An empty line parses to a null document without any malformed text.
        return doc.isNotNull() & doc[_BAD].isNull() & F.ltrim("value").startswith("{") & ~other

    def by_value(parsed: Column) -> Column:
        return let(parsed, lambda v: _value(v, shape, "$"))

    def plain(doc: Column) -> Column:
        return F.struct(*[doc[f.name].alias(f.name) for f in shape])

    either = let(read, lambda doc: F.when(has_shape(doc), plain(doc)).otherwise(by_value(F.try_parse_json("value"))))
    kept = F.filter(F.array(either), lambda doc: doc.isNotNull() if good else doc.isNull())
    return lines.select("*", F.explode(kept).alias("doc"))


def all_documents(lines: DataFrame, entity: str, fields: Iterable[str] | None = None) -> DataFrame:
    """Lines (``_ord``, ``value``, …) to one row per well-formed document, with the
    short id ``_short`` and the number ``_id``, which may be null.  ``fields``
    limits the columns to what an operator reads."""
    parsed = _parse(lines, entity, good=True)
    rest = [c for c in lines.columns if c != "value"]
    wanted = [f.name for f in DOCUMENTS[entity] if fields is None or f.name in {*fields, "id"}]
    return parsed.select(
        *rest,
        X.id_number(F.col("doc.id")).alias("_id"),
        X.short_id(F.col("doc.id")).alias("_short"),
        *[F.col(f"doc.{name}") for name in wanted],
    )


def documents(lines: DataFrame, entity: str, fields: Iterable[str] | None = None) -> DataFrame:
    """Documents that have an id number; the others yield no rows anywhere (F1)."""
    return all_documents(lines, entity, fields).where(F.col("_id").isNotNull())


def malformed(lines: DataFrame, entity: str) -> DataFrame:
    """C4: the lines that are no JSON object."""
    return _parse(lines, entity, good=False).drop("doc")
