"""Entity documents made from the given tables, one document per table row.

The raw values are SQL expressions both Spark and the checking engine
understand, written once: the builders put them into JSON text, the expected
tables in ``expected.py`` start from the same raw values on flat rows.  ``k`` is
the row's key and ``i`` the number of a child element.  No document gathers
other rows, so its size never depends on how often a key occurs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from starfold.fixed import ID_URL_PREFIX as URL
from starfold.session import spread

MOST = 6  # most child elements any list below has


def record_id(letter: str) -> str:
    """Ids in four forms; two of them have no number, so their records vanish."""
    return (
        f"CASE WHEN k % 11 = 0 THEN NULL WHEN k % 17 = 0 THEN 'none' "
        f"WHEN k % 13 = 0 THEN '{letter}' || k ELSE '{URL}{letter}' || k END"
    )


VALID = "k % 11 <> 0 AND k % 17 <> 0"

DAY = "{day}"  # replaced by the row's day as YYYY-MM-DD text in each engine


@dataclass(frozen=True)
class Child:
    """A list in a document: how many elements, and their fields (or one text)."""

    count: str
    fields: dict[str, str] = field(default_factory=dict)
    text: str | None = None


@dataclass(frozen=True)
class Fixture:
    source: str
    key: str
    letter: str
    day: str  # column or number of days after 2020-01-01
    fields: dict[str, str]
    objects: dict[str, tuple[str, dict[str, str]]] = field(default_factory=dict)
    children: dict[str, Child] = field(default_factory=dict)
    spliced: dict[str, str] = field(default_factory=dict)  # raw JSON text


def dates() -> dict[str, str]:
    return {
        "updated_date": f"CASE WHEN k % 3 = 0 THEN {DAY} || 'T10:11:12Z' ELSE {DAY} || 'T10:11:12.123' END",
        "created_date": f"CASE k % 4 WHEN 0 THEN {DAY} WHEN 1 THEN {DAY} || 'T10:11:12' "
        "WHEN 2 THEN 'soon' ELSE NULL END",
    }


def pictures() -> dict[str, str]:
    return {"image_url": "'http://img/' || k", "image_thumbnail_url": "'http://thumb/' || k"}


def alternatives(stem: str) -> Child:
    """Names with blanks, nulls and repeats in between."""
    return Child(
        "k % 7",
        text=f"CASE WHEN (k + i) % 5 = 0 THEN NULL WHEN (k + i) % 7 = 0 THEN '' ELSE '{stem} ' || ((k * i) % 4) END",
    )


def linked(letter: str, count: str = "k % 5") -> Child:
    """Ids in three forms, some without number."""
    return Child(
        count,
        text=f"CASE WHEN (k + i) % 6 = 0 THEN 'none' WHEN (k + i) % 4 = 0 THEN '{letter}' || (k + i) "
        f"ELSE '{URL}{letter}' || ((k * i) % 97) END",
    )


def roles() -> Child:
    return Child(
        "k % 7",
        {
            "role": "CASE (k + i) % 3 WHEN 0 THEN 'funder' WHEN 1 THEN 'publisher' ELSE 'institution' END",
            "id": f"CASE WHEN (k + i) % 10 = 0 THEN NULL ELSE '{URL}X' || (k + 10 * i) END",
        },
    )


WIKI = "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'Q' || k ELSE 'https://www.wikidata.org/wiki/Q' || k || '/' END"
ROR = "CASE WHEN k % 4 = 0 THEN NULL ELSE 'https://ror.org/0' || (k % 900) || CASE WHEN k % 2 = 0 THEN '/' ELSE '' END END"
ROLE_NUMBER = "k + 10 * i"

SOURCE_OF_WORK = "k % 97"
PRIMARY = (
    f"""'{{"version":"publishedVersion","source":{{"id":"{URL}S' || ({SOURCE_OF_WORK}) || '",'"""
    f""" || '"display_name":"Source ' || ({SOURCE_OF_WORK}) || '","is_in_doaj":' """
    """|| CASE WHEN k % 10 = 0 THEN 'true' ELSE 'false' END || '},"license":"cc-by"}'"""
)
# The same object with its keys in another order, and one with a null key more.
PRIMARY_REORDERED = (
    """'{"license":"cc-by","source":{"is_in_doaj":' || CASE WHEN k % 10 = 0 THEN 'true' ELSE 'false' END """
    f"""|| ',"display_name":"Source ' || ({SOURCE_OF_WORK}) || '","id":"{URL}S' || ({SOURCE_OF_WORK}) """
    """|| '"},"version":"publishedVersion"}'"""
)
PRIMARY_WITH_NULL = (
    """'{"pdf_url":null,"license":"cc-by","source":{"is_in_doaj":' || CASE WHEN k % 10 = 0 THEN 'true' ELSE 'false' END """
    f"""|| ',"display_name":"Source ' || ({SOURCE_OF_WORK}) || '","id":"{URL}S' || ({SOURCE_OF_WORK}) """
    """|| '"},"version":"publishedVersion"}'"""
)
BEST = (
    """'{"version":" acceptedVersion ","license":"' || CASE WHEN k % 2 = 0 THEN 'CC0' ELSE 'Implied' END """
    """|| '","is_oa":' || CASE WHEN k % 3 = 0 THEN 'true' ELSE 'null' END """
    """|| ',"landing_page_url":"http://land/' || k || '"}'"""
)
LOCATIONS = (
    f"'[' || CASE WHEN k % 3 = 0 THEN {PRIMARY_REORDERED} ELSE {PRIMARY_WITH_NULL} END "
    f"""|| ',' || '{{"version":"AcceptedVersion","pdf_url":"http://pdf/' || k || '","license":""}}' """
    f"|| ',' || {BEST} || ']'"
)

AUTHOR_COUNT = "(k % 4 + 1)"
AUTHOR_ID = "((k * 7 + i * 3) % 400)"
NAME = "CASE WHEN (k + i) % 5 = 0 OR (k + i) % 11 = 0 THEN '' ELSE '  Name ' || ((k * i) % 300) || '   x ' END"
DISPLAY = "CASE WHEN (k + i) % 11 = 0 THEN NULL ELSE 'name ' || ((k * i) % 300) || ' X' END"
POSITION = f"CASE WHEN i = 1 THEN 'first' WHEN i = {AUTHOR_COUNT} THEN 'last' ELSE 'middle' END"
CORRESPONDING = "(k + i) % 2 = 0"
COUNTRY_1 = "'C' || ((k + i) % 10)"
COUNTRY_4 = "'D' || (k % 10)"
NO_TEXT = "(k + i) % 7 = 0"
ONE_TEXT = "(k + i) % 4 = 0"
UNIV_1 = "((k + i) % 9)"
UNIV_2 = "((k + i + 1) % 9)"
DEPT = "(k % 5)"

WORKS = Fixture(
    "orders", "o_orderkey", "W", "o_orderdate",
    fields={
        "type": "CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'journal_article' WHEN 2 THEN 'Book' "
        "WHEN 3 THEN '' ELSE 'data_set' END",
        "type_crossref": "CASE k % 3 WHEN 0 THEN 'posted_content' WHEN 1 THEN NULL ELSE '' END",
        "title": "CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE ' On  ' || o_orderpriority || '  ' || k END",
        "display_name": "CASE k % 3 WHEN 0 THEN NULL ELSE 'Display   ' || o_orderpriority END",
        "doi": "'HTTPS://DOI.ORG/10.2/C' || k",
        "doi_registration_agency": "CASE k % 4 WHEN 0 THEN 'DataCite' WHEN 1 THEN ' Crossref ' WHEN 2 THEN '' ELSE NULL END",
        "publication_date": DAY,
        "publication_year": "CASE WHEN k % 8 = 0 THEN NULL ELSE 1990 + k % 30 END",
        "language": "CASE k % 4 WHEN 0 THEN 'EN-us' WHEN 1 THEN 'f' WHEN 2 THEN '' ELSE NULL END",
        "is_paratext": "CASE k % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN ' y ' WHEN 3 THEN 'maybe' "
        "WHEN 4 THEN '0' ELSE NULL END",
        "is_retracted": "k % 2 = 0",
        "fulltext_origin": "CASE k % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'ngrams' ELSE NULL END",
        "referenced_works_count": "k % 50",
        "cited_by_count": "k % 20",
        **dates(),
    },
    objects={
        "ids": ("TRUE", {
            "doi": f"CASE k % 6 WHEN 0 THEN 'https://doi.org/10.1/A' || k WHEN 1 THEN 'http://dx.doi.org/10.1/B' || k "
            "WHEN 2 THEN '' ELSE NULL END",
            "mag": "CASE WHEN k % 7 = 0 THEN 'x1' WHEN k % 7 = 1 THEN '12.7' ELSE ' ' || k || ' ' END",
            "pmid": "CASE k % 8 WHEN 0 THEN 'https://pubmed.example.org/' || (k + 10000) WHEN 1 THEN '' || k "
            "WHEN 2 THEN 'v12 of 345 or ' || (100 + k % 900) ELSE NULL END",
            "pmcid": "CASE WHEN k % 9 = 0 THEN 'PMC' || k ELSE NULL END",
            "arxiv": f"CASE WHEN k % 10 = 0 THEN '{URL}arXiv:' || k ELSE NULL END",
        }),
        "biblio": ("k % 21 <> 0", {
            "volume": "'' || (k % 100)",
            "issue": "CASE WHEN k % 2 = 0 THEN NULL ELSE '' || (k % 12) END",
            "first_page": "CASE WHEN k % 10 = 0 THEN NULL ELSE '' || (k % 300) END",
            "last_page": "CASE WHEN k % 3 = 0 THEN NULL ELSE '' || (k % 300 + 7) END",
        }),
        "open_access": ("TRUE", {
            "is_oa": "k % 3 = 0",
            "any_repository_has_fulltext": "CASE WHEN k % 2 = 0 THEN 't' ELSE 'F' END",
            "oa_status": "CASE WHEN k % 23 = 0 THEN NULL WHEN k % 19 = 0 THEN ' ' || o_orderstatus || ' ' "
            "ELSE o_orderstatus END",
            "oa_url": "'http://oa/' || k",
        }),
        "apc_list": ("k % 3 <> 0", {"provenance": "'p' || (k % 4)", "currency": "'USD'", "value": "k % 5000",
                                    "value_usd": "k % 3000"}),
        "apc_paid": ("k % 2 <> 0", {"provenance": "'Q' || (k % 3)", "currency": "'EUR'", "value": "k % 700",
                                    "value_usd": "k % 800"}),
    },
    children={
        "concepts": Child("k % 5", {
            "id": f"CASE WHEN (k + i) % 5 = 0 THEN NULL ELSE '{URL}C' || ((k * 3 + i) % 500) END",
            "score": "CAST((k + i) % 100 AS DOUBLE) / 100"}),
        "topics": Child("k % 4", {
            "id": f"CASE WHEN (k + i) % 6 = 0 THEN 'T1x' ELSE '{URL}T' || ((k * 5 + i) % 500) END",
            "score": "CAST((k * i) % 100 AS DOUBLE) / 100"}),
        "sustainable_development_goals": Child("k % 3", {
            "id": "CASE WHEN (k + i) % 9 = 0 THEN 'https://goals.example.org/none' ELSE 'https://goals.example.org/' || "
            "((k + i) % 17 + 1) || CASE WHEN i = 2 THEN '/' ELSE '' END END",
            "display_name": "'Goal ' || ((k + i) % 17 + 1) || CASE WHEN k % 2 = 0 THEN ' short' ELSE '' END",
            "score": "CAST((k + i) % 10 AS DOUBLE) / 10"}),
        "keywords": Child("k % 5", {
            "keyword": "CASE WHEN (k + i) % 7 = 0 THEN NULL WHEN (k + i) % 3 = 0 THEN '' "
            "ELSE CASE WHEN k % 2 = 0 THEN 'Word ' ELSE 'word ' END || ((k * i) % 200) END",
            "display_name": "CASE WHEN (k + i) % 7 = 0 THEN '' ELSE 'Shown ' || (k % 50) END",
            "score": "CAST(i AS DOUBLE) / 4"}),
        "mesh": Child("k % 4", {
            "descriptor_ui": "'D' || ((k + i) % 50)",
            "descriptor_name": "CASE WHEN (k + i) % 13 = 0 THEN '' ELSE 'Desc ' || ((k + i) % 50) || ' v' || (k % 4) END",
            "qualifier_ui": "CASE WHEN i = 2 THEN 'Q' || (k % 10) ELSE '' END",
            "qualifier_name": "'Qual ' || (k % 10) || ' v' || (k % 3)",
            "is_major_topic": "CASE (k + i) % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE 'perhaps' END"}),
        "grants": Child("k % 3", {
            "funder": f"CASE WHEN (k + i) % 4 = 0 THEN NULL ELSE '{URL}F' || ((k + i) % 40) END",
            "award_id": "CASE WHEN i = 2 THEN NULL ELSE 'AW-' || k END"}),
        "referenced_works": Child(
            "k % 6",
            text=f"CASE WHEN k % 3 = 0 AND i = 1 THEN 'W1' WHEN (k + i) % 8 = 0 THEN 'x' "
            f"ELSE '{URL}W' || ((k * 31 + i * 17) % (k + 5)) END"),
        "related_works": linked("W", "k % 4"),
    },
    spliced={
        "primary_location": f"CASE WHEN k % 14 = 0 THEN NULL ELSE {PRIMARY} END",
        "best_oa_location": f"CASE WHEN k % 4 = 0 THEN NULL ELSE {BEST} END",
        "locations": f"CASE WHEN k % 5 = 0 THEN NULL ELSE {LOCATIONS} END",
        "authorships": "AUTHORSHIPS",
    },
)

AUTHORSHIPS = f"""
to_json(slice(transform(sequence(1, 4), i -> named_struct(
  'author', named_struct('id', '{URL}A' || {AUTHOR_ID}, 'display_name', {DISPLAY}),
  'raw_author_name', {NAME},
  'author_position', {POSITION},
  'is_corresponding', {CORRESPONDING},
  'countries', array({COUNTRY_1}, NULL, '', {COUNTRY_4}),
  'raw_affiliation_strings', CASE WHEN {NO_TEXT} OR {ONE_TEXT} THEN array('', ' ')
     ELSE array('Univ   ' || {UNIV_1}, ' Univ ' || {UNIV_2} || ' ', '') END,
  'raw_affiliation_string', CASE WHEN {NO_TEXT} THEN NULL WHEN {ONE_TEXT}
     THEN 'Dept ' || {DEPT} || '; Lab ;; Dept ' || {DEPT} END,
  'institutions', array(named_struct('id', 'I' || (k % 50), 'display_name', 'Inst ' || (k % 50)),
                        named_struct('id', 'I' || (50 + i), 'display_name', CASE WHEN i = 3 THEN '' ELSE 'Inst ' || (50 + i) END),
                        named_struct('id', 'I' || (60 + i), 'display_name', 'Inst ' || (60 + i)))
)), 1, {AUTHOR_COUNT}))
"""

# Authorships for the institution links.  All authors share the text "Univ" and
# have one of their own; ids differ between authors, so that whether an
# authorship falls back is decided by its own data and can be stated on flat rows.
LINKED_AUTHORSHIPS = f"""
to_json(slice(transform(sequence(1, 4), i -> named_struct(
  'raw_affiliation_strings', array('Univ  ' || (k % 7), 'Lab ' || i),
  'affiliations', CASE (k + i) % 3
     WHEN 0 THEN array(named_struct('raw_affiliation_string', ' Univ ' || (k % 7),
                                    'institution_ids', array('I' || (100 * i + 1), 'none', 'I' || (100 * i + 1), 'I' || (100 * i + 2))),
                       named_struct('raw_affiliation_string', 'Lab   ' || i, 'institution_ids', array('{URL}I' || (k % 50))))
     WHEN 1 THEN array(named_struct('raw_affiliation_string', 'Nowhere', 'institution_ids', array('I1')))
     END,
  'institutions', array(named_struct('id', 'I' || (100 * i + 5)), named_struct('id', 'I' || (100 * i + 6)),
                        named_struct('id', 'I' || (100 * i + 7)), named_struct('id', 'I' || (100 * i + 6)))
)), 1, {AUTHOR_COUNT}))
"""

AUTHORS = Fixture(
    "customer", "c_custkey", "A", "k % 900",
    fields={
        "display_name": "c_name",
        "orcid": "CASE k % 6 WHEN 0 THEN 'https://orcid.org/0000-0002-1825-' || (1000 + k % 9000) WHEN 1 THEN "
        "'x 000000021825009x y' WHEN 2 THEN '0000 0002 1825 ' || (1000 + k % 9000) WHEN 3 THEN '00000002182500' ELSE NULL END",
        **dates(),
    },
    objects={"ids": ("TRUE", {
        "orcid": "CASE k % 6 WHEN 4 THEN '0000-0001-0000-' || (1000 + k % 9000) ELSE NULL END",
        "scopus": "CASE k % 4 WHEN 0 THEN 'http://www.example.org/a?AuthorID=' || k || '&x=1' WHEN 1 THEN ' ' || k || ' ' "
        "WHEN 2 THEN 'id ' || k ELSE NULL END",
        "wikipedia": "CASE WHEN k % 3 = 0 THEN 'https://en.example.org/wiki/' || k ELSE NULL END"})},
    children={
        "display_name_alternatives": alternatives("Alt"),
        "affiliations": Child("k % 5", {
            "institution": f"named_struct('id', CASE WHEN (k + i) % 5 = 0 THEN 'none' ELSE '{URL}I' || (k + i % 3) END)",
            "years": "array('' || (2000 + i), 'unknown', '' || (2010 + k % 9))"}),
        "last_known_institutions": Child("k % 4", {
            "id": f"CASE WHEN (k + i) % 5 = 0 THEN NULL ELSE '{URL}I' || ((k + i) % 3) END"}),
    },
    spliced={"last_known_institution": f"CASE WHEN k % 3 = 0 THEN '{{\"id\":\"I' || (k % 3) || '\"}}' "
                                       "WHEN k % 3 = 1 THEN '\"I7\"' ELSE NULL END"},
)

INSTITUTIONS = Fixture(
    "customer", "c_custkey", "I", "k % 900",
    fields={
        "display_name": "c_name",
        "type": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 8 = 0 THEN ' ' || lower(c_mktsegment) ELSE lower(c_mktsegment) END",
        "country_code": "CASE WHEN k % 10 = 0 THEN '' ELSE 'N' || c_nationkey END",
        "homepage_url": "'http://home/' || k",
        "ror": ROR,
        "is_super_system": "CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'F' ELSE NULL END",
        **pictures(), **dates(),
    },
    objects={
        "geo": ("k % 12 <> 0", {
            "region": "CASE WHEN k % 7 = 0 THEN '' ELSE 'Region ' || (c_nationkey % 5) END",
            "geonames_city_id": "CASE WHEN k % 6 = 0 THEN '0' WHEN k % 6 = 1 THEN 'n/a' ELSE '' || (k % 200) END",
            "city": "CASE WHEN k % 15 = 0 THEN '' ELSE 'City ' || (k % 200) || ' v' || (k % 3) END",
            "country": "CASE WHEN k % 4 = 0 THEN NULL ELSE 'Nation ' || c_nationkey || ' v' || (k % 2) END",
            "latitude": "CASE WHEN k % 5 = 0 THEN 'north' ELSE '' || (k % 90) || '.5' END",
            "longitude": "'-' || (k % 180) || '.25'"}),
        "ids": ("TRUE", {"wikidata": WIKI, "wikipedia": "'https://en.example.org/wiki/I' || k", "mag": "'' || k",
                         "grid": "'grid.' || k"}),
    },
    children={
        "display_name_acronyms": alternatives("ACR"),
        "display_name_alternatives": alternatives("Name"),
        "associated_institutions": Child("k % 5", {
            "id": f"CASE WHEN (k + i) % 5 = 0 THEN NULL ELSE '{URL}I' || (k + i) END",
            "relationship": "CASE (k + i) % 4 WHEN 0 THEN 'parent' WHEN 1 THEN 'child' WHEN 2 THEN '' ELSE 'Related' END"}),
        "roles": roles(),
        "repositories": Child("k % 4", {"id": f"CASE WHEN (k + i) % 5 = 0 THEN 'S' ELSE '{URL}S' || (k + i) END"}),
        "lineage": linked("I"),
    },
    spliced={"international":
             "'{\"display_name\":{\"fr\":\"Nom ' || k || '\",\"de\":' || CASE WHEN k % 2 = 0 THEN 'null' "
             "ELSE '\"Name ' || k || '\"' END || ',\"en\":\"' || CASE WHEN k % 3 = 0 THEN '' ELSE 'Name' END || '\"}}'"},
)

CONCEPTS = Fixture(
    "part", "p_partkey", "C", "k % 900",
    fields={
        "display_name": "p_name", "description": "p_type || ' of ' || p_brand", "level": "p_size % 6",
        "wikidata": WIKI, **pictures(), **dates(),
    },
    objects={"ids": ("k % 16 <> 0", {
        "wikidata": "CASE WHEN k % 3 = 0 THEN 'https://www.wikidata.org/entity/Q9' || k ELSE '' END",
        "wikipedia": "'https://en.example.org/wiki/C' || k", "mag": "CASE WHEN k % 7 = 0 THEN '' ELSE '' || (2 * k) END",
        "umls_cui": "CASE k % 3 WHEN 0 THEN array('C' || k, '', 'C' || k, 'CX') WHEN 1 THEN array('', 'C1') ELSE NULL END",
        "umls_aui": "CASE k % 4 WHEN 0 THEN array('A' || k, NULL, 'A9') ELSE array('A7') END"})},
    children={
        "related_concepts": Child("k % 5", {
            "id": f"CASE WHEN (k + i) % 6 = 0 THEN NULL ELSE '{URL}C' || (k + i) END",
            "score": "CAST((k + i) % 1000 AS DOUBLE) / 1000"}),
    },
    spliced={
        # Objects, ids and a null in one list.
        "ancestors": "CASE k % 3 WHEN 0 THEN '[{\"id\":\"C' || (k + 1) || '\"},\"C' || (k + 2) || '\",null,{\"name\":\"5\"},{\"id\":\"C3\"}]' "
                     f"WHEN 1 THEN '[\"{URL}C' || k || '\"]' ELSE '[]' END",
        "international":
            "'{\"display_name\":{\"en\":\"' || p_name || '\",\"xx\":\"\"},\"description\":{\"en\":\"' || p_type "
            "|| '\",\"fr\":' || CASE WHEN k % 2 = 0 THEN 'null' ELSE '\"fr ' || p_type || '\"' END || '}}'"},
)

ISSN_1 = "(1000 + k % 9000)"
SOURCES = Fixture(
    "part", "p_partkey", "S", "k % 900",
    fields={
        "display_name": "p_name || ' ' || k", "abbreviated_title": "CASE WHEN k % 2 = 0 THEN NULL ELSE 'J. ' || p_brand END",
        "type": "CASE WHEN k % 10 = 0 THEN NULL ELSE lower(p_type) END", "country_code": "'N' || (k % 25)",
        "host_organization": f"CASE k % 5 WHEN 0 THEN '{URL}P' || k WHEN 1 THEN '{URL}I' || k WHEN 2 THEN 'X' || k "
                             "WHEN 3 THEN '' ELSE NULL END",
        "publisher_id": "CASE WHEN k % 2 = 0 THEN 'P' || (k + 7) ELSE 'I' || k END",
        "homepage_url": "'http://home/' || k",
        "issn_l": f"CASE k % 4 WHEN 0 THEN 'urn:issn:' || {ISSN_1} || '-567x' WHEN 1 THEN '1234567X' WHEN 2 THEN '' ELSE NULL END",
        "is_in_doaj": "k % 2 = 0", "is_oa": "CASE WHEN k % 3 = 0 THEN '1' ELSE 'off' END",
        "apc_usd": "CASE WHEN k % 6 = 0 THEN 'free' ELSE '' || (k % 4000) END", **dates(),
    },
    objects={"ids": ("TRUE", {
        "wikidata": WIKI, "fatcat": "CASE WHEN k % 3 = 0 THEN NULL ELSE 'https://fatcat.example/container/abc' || k || '/' END",
        "mag": "'' || k", "issn_l": f"'ISSN ' || {ISSN_1} || '-0000'",
        "issn": f"array('' || {ISSN_1} || '-1111', 'bad')"})},
    children={
        "alternate_titles": alternatives("Title"),
        "issn": Child("k % 4", text=f"CASE WHEN (k + i) % 3 = 0 THEN 'none' WHEN (k + i) % 3 = 1 THEN ' urn:issn:' || {ISSN_1} || '-222x' "
                                    f"ELSE '' || {ISSN_1} || '-222X' END"),
        "apc_prices": Child("k % 5", {
            "price": "CASE WHEN (k + i) % 4 = 0 THEN NULL ELSE 100 * i + k % 50 END",
            "currency": "CASE (k + i) % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE '' END"}),
        "societies": Child("k % 4", {
            "organization": "CASE WHEN (k + i) % 3 = 0 THEN '' ELSE 'Org ' || (k % 30) END",
            "name": "CASE WHEN (k + i) % 6 = 0 THEN NULL ELSE 'Name ' || k END",
            "url": "CASE WHEN (k + i) % 4 = 0 THEN 'http://soc/' || k ELSE NULL END"}),
    },
)

FUNDERS = Fixture(
    "customer", "c_custkey", "F", "k % 900",
    fields={
        "display_name": "c_name", "country_code": "'N' || c_nationkey", "description": "c_mktsegment",
        "homepage_url": "'http://home/' || k", "ror": "'https://ror.org/09' || (k % 99)", **pictures(), **dates(),
    },
    objects={"ids": ("TRUE", {"wikidata": WIKI, "wikipedia": "'w' || k", "ror": ROR})},
    children={"alternate_titles": alternatives("Fund"), "roles": roles()},
)

PUBLISHERS = Fixture(
    "customer", "c_custkey", "P", "k % 900",
    fields={
        "display_name": "c_name", "homepage_url": "'http://home/' || k",
        "hierarchy_level": "k % 3", **pictures(), **dates(),
    },
    objects={"ids": ("k % 9 <> 0", {"wikidata": WIKI, "wikipedia": "'w' || k", "ror": ROR})},
    children={
        "alternate_titles": alternatives("Press"),
        "country_codes": Child("k % 6", text="CASE WHEN (k + i) % 4 = 0 THEN '' ELSE 'N' || ((c_nationkey + i % 2) % 25) END"),
    },
    spliced={"parent_publisher": f"CASE k % 3 WHEN 0 THEN '{{\"id\":\"{URL}P' || (k + 1) || '\"}}' WHEN 1 THEN '\"P5\"' ELSE NULL END"},
)


def _level(letter_up: dict[str, str], below: str | None) -> Fixture:
    children = {"siblings": Child("k % 5", {"id": f"CASE WHEN (k + i) % 6 = 0 THEN NULL ELSE '{URL}things/' || (k + i) END"})}
    if below:
        children["display_name_alternatives"] = alternatives("Also")
        children[below] = linked(below + "/")
    else:
        children["keywords"] = Child("k % 6", text="CASE WHEN (k + i) % 4 = 0 THEN '' ELSE p_name || ' ' || (i % 2) END")
    return Fixture(
        "part", "p_partkey", "things/", "k % 900",
        fields={"display_name": "p_name", "description": "p_type", **dates()},
        objects={"ids": ("k % 8 <> 0", {"wikidata": WIKI, "wikipedia": "'w' || k"}),
                 **{a: (f"k % {n + 5} <> 0", {"id": f"'{URL}{a}s/' || (k % {v})"}) for n, (a, v) in enumerate(letter_up.items())}},
        children=children,
    )


FIXTURES: dict[str, Fixture] = {
    "works": WORKS, "authors": AUTHORS, "institutions": INSTITUTIONS, "concepts": CONCEPTS, "sources": SOURCES,
    "funders": FUNDERS, "publishers": PUBLISHERS,
    "domains": _level({}, "fields"),
    "fields": _level({"domain": "4"}, "subfields"),
    "subfields": _level({"domain": "4", "field": "26"}, "topics"),
    "topics": _level({"domain": "4", "field": "26", "subfield": "252"}, None),
}


def spark_day(f: Fixture) -> str:
    if f.day.endswith("date"):
        return f"date_format({f.day}, 'yyyy-MM-dd')"
    return f"date_format(date_add(date'2020-01-01', CAST({f.day} AS INT)), 'yyyy-MM-dd')"


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def lines(
    spark: SparkSession,
    sf_dir: str,
    entity: str,
    authorships: str = AUTHORSHIPS,
    fields_wanted: set[str] | None = None,
) -> DataFrame:
    """The entity's documents as JSON text in ``value``, with scan order ``_ord``;
    whole, or with no more than the wanted fields."""
    f = FIXTURES[entity]

    def wanted(named: dict) -> dict:
        return {n: v for n, v in named.items() if fields_wanted is None or n in fields_wanted}

    fields = {"id": record_id(f.letter), **wanted(f.fields)}
    for name, (given, inner) in wanted(f.objects).items():
        fields[name] = f"CASE WHEN {given} THEN {_struct(inner)} END"
    for name, c in wanted(f.children).items():
        element = c.text or _struct(c.fields)
        fields[name] = f"slice(transform(sequence(1, {MOST}), i -> {element}), 1, CAST({c.count} AS INT))"
    spliced = "".join(
        f"""coalesce('"{name}":' || ({authorships if name == 'authorships' else text}) || ',', '') || """
        for name, text in wanted(f.spliced).items()
    )
    # A field that is never null, so that a comma always fits.
    fields["origin"] = f"'{f.source}'"
    body = f"to_json({_struct(fields)})".replace(DAY, spark_day(f))
    rows = spread(spark.read.parquet(f"{sf_dir}/{f.source}.parquet").withColumnRenamed(f.key, "k"))
    return rows.selectExpr("k AS _ord", f"'{{' || {spliced} substr({body}, 2) AS value")
