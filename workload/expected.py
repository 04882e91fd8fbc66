"""Expected output tables, stated as plain SQL on the flat rows.

Nothing nested is built here: list elements are rows ``(k, i)``, and each rule
of the table is written out as filters, groupings and row numbers.
"""

from __future__ import annotations

from starfold.fixed import ID_URL_PREFIX as URL
from starfold.fixed import SHORT_ID

from . import fixtures as fx
from .fixtures import DAY, FIXTURES, MOST, VALID


def sql_day(entity: str) -> str:
    day = FIXTURES[entity].day
    if day.endswith("date"):
        return f"strftime({day}, '%Y-%m-%d')"
    return f"strftime(DATE '2020-01-01' + CAST({day} AS INTEGER), '%Y-%m-%d')"


def raw(entity: str) -> str:
    """Scalar fields of each document, objects flattened as ``object_field``."""
    f = FIXTURES[entity]
    cols = [f"{e} AS d_{n}" for n, e in f.fields.items()]
    for name, (given, inner) in f.objects.items():
        cols += [
            f"CASE WHEN {given} THEN {e} END AS d_{name}_{n}" for n, e in inner.items() if "array(" not in e
        ]
    cols.append(f"{fx.record_id(f.letter)} AS d_id")
    text = ", ".join(cols).replace(DAY, sql_day(entity))
    return f"(SELECT k, {text} FROM (SELECT *, {f.key} AS k FROM {f.source}) WHERE {VALID})"


def rows(entity: str) -> str:
    f = FIXTURES[entity]
    return f"(SELECT * FROM (SELECT *, {f.key} AS k FROM {f.source}) WHERE {VALID})"


def elements(entity: str, name: str) -> str:
    """List elements as rows ``(k, i, fields)``; a list of texts has the field ``v``."""
    c = FIXTURES[entity].children[name]
    fields = {"v": c.text} if c.text else c.fields
    cols = ", ".join(f"{e} AS {n}" for n, e in fields.items() if "array(" not in e and "struct(" not in e)
    return (
        f"(SELECT k, i{', ' + cols if cols else ''} FROM {rows(entity)}, "
        f"(SELECT unnest(generate_series(1, {MOST})) AS i) WHERE i <= {c.count})"
    )


def num(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '^[^0-9]*([0-9]+)$', 1), '') AS BIGINT)"


def whole(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^-?[0-9]+$') THEN CAST(trim({x}) AS BIGINT) END"


def segment(x: str) -> str:
    return f"nullif(regexp_extract(rtrim({x}, '/'), '[^/]+$'), '')"


def day(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-') THEN substr({x}, 1, 10) END"


def flag(x: str) -> str:
    return (
        f"CASE WHEN lower(trim({x})) IN ('true', 't', '1', 'yes', 'y') THEN CAST(1 AS BIGINT) "
        f"WHEN lower(trim({x})) IN ('false', 'f', '0', 'no', 'n') THEN CAST(0 AS BIGINT) END"
    )


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def numbers(values: str) -> str:
    """Distinct values ``v`` with dense ids, ordered by folded text, then text."""
    return (
        f"(SELECT v, row_number() OVER (ORDER BY lower(v), v) AS id FROM "
        f"(SELECT DISTINCT v FROM ({values}) WHERE v <> ''))"
    )


def short_and_dates() -> str:
    return f"replace(d_id, '{URL}', '') AS {SHORT_ID}, {dates()}"


def dates() -> str:
    return f"{day('d_updated_date')} AS updated_date, {day('d_created_date')} AS created_date"


def names(entity: str, child: str, owner: str, seq: str, column: str, value: str = "v") -> str:
    """Dense numbers over distinct non-blank texts."""
    return (
        f"SELECT k AS {owner}, row_number() OVER (PARTITION BY k ORDER BY i) AS {seq}, v AS {column} FROM "
        f"(SELECT k, v, min(i) AS i FROM (SELECT k, i, {value} AS v FROM {elements(entity, child)}) "
        f"WHERE v <> '' GROUP BY k, v)"
    )


def ids(entity: str, child: str, owner: str, seq: str, column: str, value: str = "v", where: str = "TRUE",
        more: str = "") -> str:
    """Dense numbers over elements that have an id number."""
    return (
        f"SELECT k AS {owner}, row_number() OVER (PARTITION BY k ORDER BY i) AS {seq}, n AS {column}{more} FROM "
        f"(SELECT *, {num(value)} AS n FROM {elements(entity, child)}) WHERE n IS NOT NULL AND {where}"
    )


def listed(values: list[tuple[str, str]]) -> str:
    """Rows ``(k, i, v)`` from ``(condition, text)`` pairs, one per place in a list."""
    return "(" + " UNION ALL ".join(
        f"SELECT k, {i} AS i, {text} AS v FROM r WHERE {given}" for i, (given, text) in enumerate(values, 1)
    ) + ")"


# --- enumerations: the values feeding them -----------------------------------

W = raw("works")
TYPE = "translate(coalesce(nullif(d_type, ''), 'other'), '_', '-')"
CROSSREF = f"coalesce(nullif(d_type_crossref, ''), {TYPE})"

SOURCE_NAMES = (
    "(SELECT k, 1 AS o, 'arxiv' AS v FROM w0 WHERE k % 10 = 0 "
    "UNION ALL SELECT k, 2, 'pubmed' FROM w0 WHERE k % 8 IN (0, 1, 2) OR k % 9 = 0 "
    "UNION ALL SELECT k, 3, 'datacite' FROM w0 WHERE k % 4 = 0 "
    "UNION ALL SELECT k, 3, 'crossref' FROM w0 WHERE k % 4 = 1 "
    "UNION ALL SELECT k, 4, 'doaj' FROM w0 WHERE k % 10 = 0 AND k % 14 <> 0)"
).replace("w0", f"(SELECT k FROM {rows('works')})")

LOCATION_ROWS = (
    "(SELECT k, i, CASE i WHEN 1 THEN 'publishedVersion' WHEN 2 THEN 'AcceptedVersion' ELSE ' acceptedVersion ' END AS version, "
    "CASE i WHEN 1 THEN 'cc-by' WHEN 2 THEN '' ELSE CASE WHEN k % 2 = 0 THEN 'CC0' ELSE 'Implied' END END AS license "
    f"FROM {rows('works')}, (SELECT unnest([1, 2, 3]) AS i) WHERE k % 5 <> 0)"
)

AUTHOR_ROWS = (
    f"(SELECT *, row_number() OVER () AS any_order FROM {rows('works')}, "
    f"(SELECT unnest([1, 2, 3, 4]) AS i) WHERE i <= {fx.AUTHOR_COUNT})"
)

# Affiliation texts (k, author i, place j, text v), cleaned.
TEXT_ROWS = (
    f"(SELECT k, i, 1 AS j, 'Univ ' || {fx.UNIV_1} AS v FROM {AUTHOR_ROWS} WHERE NOT ({fx.NO_TEXT}) AND NOT ({fx.ONE_TEXT}) "
    f"UNION ALL SELECT k, i, 2, 'Univ ' || {fx.UNIV_2} FROM {AUTHOR_ROWS} WHERE NOT ({fx.NO_TEXT}) AND NOT ({fx.ONE_TEXT}) "
    f"UNION ALL SELECT k, i, j, CASE j WHEN 2 THEN 'Lab' ELSE 'Dept ' || {fx.DEPT} END FROM {AUTHOR_ROWS}, "
    f"(SELECT unnest([1, 2, 3]) AS j) WHERE NOT ({fx.NO_TEXT}) AND ({fx.ONE_TEXT}))"
)
AFFILIATIONS = (
    "(SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY first_at) AS seq FROM "
    f"(SELECT k, v, min(i * 10 + j) AS first_at FROM {TEXT_ROWS} GROUP BY k, v))"
)
NAMES = (
    "(SELECT k, i, nullif(trim(regexp_replace(coalesce(nullif(" + fx.NAME + ", ''), nullif(" + fx.DISPLAY
    + f", '')), '\\s+', ' ', 'g')), '') AS v FROM {AUTHOR_ROWS})"
)
KEYWORDS = (
    "(SELECT k, i, score, coalesce(nullif(keyword, ''), nullif(display_name, '')) AS v "
    f"FROM {elements('works', 'keywords')})"
)
INST = raw("institutions")

VALUES: dict[str, str] = {
    "work_type": f"SELECT {TYPE} AS v FROM {W} UNION ALL SELECT {CROSSREF} FROM {W}",
    "doi_registration_agency": f"SELECT trim(d_doi_registration_agency) AS v FROM {W}",
    "oa_status": f"SELECT trim(d_open_access_oa_status) AS v FROM {W}",
    "apc_provenance": f"SELECT d_apc_list_provenance AS v FROM {W} UNION ALL SELECT d_apc_paid_provenance FROM {W}",
    "fulltext_origin": f"SELECT d_fulltext_origin AS v FROM {W}",
    "data_source": f"SELECT v FROM {SOURCE_NAMES}",
    "version": f"SELECT trim(version) AS v FROM {LOCATION_ROWS}",
    "license": f"SELECT trim(license) AS v FROM {LOCATION_ROWS}",
    "author_position": f"SELECT {fx.POSITION} AS v FROM {AUTHOR_ROWS}",
    "institution_type": f"SELECT trim(d_type) AS v FROM {INST}",
    "institution_relationship_type":
        f"SELECT trim(relationship) AS v FROM {elements('institutions', 'associated_institutions')} WHERE {num('id')} IS NOT NULL",
    "region": f"SELECT trim(d_geo_region) AS v FROM {INST}",
    "source_type": f"SELECT trim(d_type) AS v FROM {raw('sources')}",
    "keyword": f"SELECT v FROM {KEYWORDS}",
    "raw_affiliation_string": f"SELECT v FROM {TEXT_ROWS}",
    "raw_author_name": f"SELECT v FROM {NAMES}",
}

EXPECTED: dict[str, str] = {
    name: f"SELECT id AS {name}_id, v AS {name} FROM {numbers(values)}" for name, values in VALUES.items()
}


def catalogue(name: str) -> str:
    return numbers(VALUES[name])


# --- works -------------------------------------------------------------------

EXPECTED["work"] = f"""
SELECT w.k AS work_id, t.id AS work_type_id, c.id AS crossref_work_type_id,
  CASE WHEN w.k % 14 <> 0 THEN {big(fx.SOURCE_OF_WORK.replace('k', 'w.k'))} END AS source_id,
  d_publication_date AS pub_date, {big('d_publication_year')} AS pub_year,
  d_biblio_volume AS volume, d_biblio_issue AS issue, d_biblio_first_page AS page_first, d_biblio_last_page AS page_last,
  g.id AS doi_registration_agency_id,
  CASE w.k % 6 WHEN 0 THEN '10.1/A' || w.k WHEN 1 THEN 'http://dx.doi.org/10.1/B' || w.k ELSE '10.2/C' || w.k END AS doi,
  replace(d_id, '{URL}', '') AS {SHORT_ID}, {whole('d_ids_mag')} AS mag_id,
  CASE w.k % 8 WHEN 0 THEN w.k + 10000 WHEN 1 THEN w.k WHEN 2 THEN 100 + w.k % 900 END AS pmid,
  CASE WHEN w.k % 9 = 0 THEN w.k END AS pmcid,
  CASE WHEN w.k % 10 = 0 THEN 'arXiv:' || w.k END AS arxiv_id,
  CASE w.k % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'f' END AS language_iso2_code,
  {flag('d_is_paratext')} AS is_paratext, {big('d_is_retracted')} AS is_retracted, {big('d_open_access_is_oa')} AS is_oa,
  {flag('d_open_access_any_repository_has_fulltext')} AS any_repository_has_fulltext,
  s.id AS oa_status_id, d_open_access_oa_url AS oa_url,
  d_apc_list_currency AS apc_list_currency, {big('d_apc_list_value')} AS apc_list_price,
  {big('d_apc_list_value_usd')} AS apc_list_price_usd, l.id AS apc_list_apc_provenance_id,
  d_apc_paid_currency AS apc_paid_currency, {big('d_apc_paid_value')} AS apc_paid_price,
  {big('d_apc_paid_value_usd')} AS apc_paid_price_usd, p.id AS apc_paid_apc_provenance_id,
  f.id AS fulltext_origin_id, {big('d_referenced_works_count')} AS n_refs, {big('d_cited_by_count')} AS n_cits, {dates()}
FROM {W} w
LEFT JOIN {catalogue('work_type')} t ON t.v = {TYPE}
LEFT JOIN {catalogue('work_type')} c ON c.v = {CROSSREF}
LEFT JOIN {catalogue('doi_registration_agency')} g ON g.v = trim(d_doi_registration_agency)
LEFT JOIN {catalogue('oa_status')} s ON s.v = trim(d_open_access_oa_status)
LEFT JOIN {catalogue('apc_provenance')} l ON l.v = d_apc_list_provenance
LEFT JOIN {catalogue('apc_provenance')} p ON p.v = d_apc_paid_provenance
LEFT JOIN {catalogue('fulltext_origin')} f ON f.v = d_fulltext_origin"""

TITLE = "nullif(trim(regexp_replace(coalesce(nullif(d_title, ''), nullif(d_display_name, '')), '\\s+', ' ', 'g')), '')"
EXPECTED["work_title"] = f"SELECT * FROM (SELECT k AS work_id, {TITLE} AS title FROM {W}) WHERE title IS NOT NULL"

for _name, _child in (("concept", "concepts"), ("topic", "topics")):
    _primary = ", CAST(NULL AS BIGINT) AS is_primary_topic" if _name == "topic" else ""
    EXPECTED[f"work_{_name}"] = (
        f"SELECT k AS work_id, {big('i')} AS {_name}_seq, {num('id')} AS {_name}_id, score{_primary} "
        f"FROM {elements('works', _child)} WHERE {num('id')} IS NOT NULL"
    )

GOALS = elements("works", "sustainable_development_goals")
GOAL_ID = f"TRY_CAST({segment('id')} AS BIGINT)"
EXPECTED["work_sustainable_development_goal"] = (
    f"SELECT k AS work_id, {big('i')} AS sustainable_development_goal_seq, "
    f"{GOAL_ID} AS sustainable_development_goal_id, score FROM {GOALS}"
)
EXPECTED["sustainable_development_goal"] = (
    f"SELECT g AS sustainable_development_goal_id, display_name AS sustainable_development_goal, id AS taxonomy_url FROM "
    f"(SELECT *, {GOAL_ID} AS g, row_number() OVER (PARTITION BY {GOAL_ID} ORDER BY k, i) AS rn FROM {GOALS}) "
    "WHERE g IS NOT NULL AND rn = 1"
)
EXPECTED["work_keyword"] = (
    f"SELECT e.k AS work_id, {big('e.i')} AS keyword_seq, c.id AS keyword_id, e.score "
    f"FROM {KEYWORDS} e JOIN {catalogue('keyword')} c ON c.v = e.v"
)
MESH = elements("works", "mesh")
for _kind in ("descriptor", "qualifier"):
    EXPECTED[f"mesh_{_kind}"] = (
        f"SELECT {_kind}_ui AS mesh_{_kind}_ui, {_kind}_name AS mesh_{_kind} FROM (SELECT *, "
        f"row_number() OVER (PARTITION BY {_kind}_ui ORDER BY k, i) AS rn FROM {MESH} "
        f"WHERE {_kind}_ui <> '' AND {_kind}_name <> '') WHERE rn = 1"
    )
EXPECTED["work_mesh"] = (
    f"SELECT k AS work_id, {big('i')} AS mesh_seq, descriptor_ui AS mesh_descriptor_ui, "
    f"qualifier_ui AS mesh_qualifier_ui, {flag('is_major_topic')} AS is_major_topic FROM {MESH}"
)
EXPECTED["work_location"] = f"""
SELECT e.k AS work_id, {big('e.i')} AS location_seq,
  {big('e.i = 1 AND e.k % 3 = 0 AND e.k % 14 <> 0')} AS is_primary_location,
  {big('e.i = 3 AND e.k % 4 <> 0')} AS is_best_oa_location,
  CASE WHEN e.i = 1 THEN {big(fx.SOURCE_OF_WORK.replace('k', 'e.k'))} END AS source_id,
  CASE WHEN e.i = 3 THEN 'http://land/' || e.k END AS landing_page_url,
  CASE WHEN e.i = 2 THEN 'http://pdf/' || e.k END AS pdf_url,
  v.id AS version_id, l.id AS license_id,
  CASE WHEN e.i = 3 AND e.k % 3 = 0 THEN CAST(1 AS BIGINT) END AS is_oa,
  {big('e.i = 2')} AS is_accepted, {big('e.i = 1')} AS is_published
FROM {LOCATION_ROWS} e LEFT JOIN {catalogue('version')} v ON v.v = trim(e.version)
LEFT JOIN {catalogue('license')} l ON l.v = trim(e.license)"""
EXPECTED["work_affiliation"] = (
    f"SELECT a.k AS work_id, a.seq AS affiliation_seq, c.id AS raw_affiliation_string_id "
    f"FROM {AFFILIATIONS} a JOIN {catalogue('raw_affiliation_string')} c ON c.v = a.v"
)
EXPECTED["work_author_affiliation"] = (
    f"SELECT t.k AS work_id, {big('t.i')} AS author_seq, a.seq AS affiliation_seq "
    f"FROM {TEXT_ROWS} t JOIN {AFFILIATIONS} a ON a.k = t.k AND a.v = t.v"
)
EXPECTED["work_author"] = (
    f"SELECT a.k AS work_id, {big('a.i')} AS author_seq, {big(fx.AUTHOR_ID.replace('k ', 'a.k ').replace('i ', 'a.i '))} AS author_id, "
    f"p.id AS author_position_id, {big('(a.k + a.i) % 2 = 0')} AS is_corresponding_author, r.id AS raw_author_name_id "
    f"FROM (SELECT *, {fx.POSITION} AS position FROM {AUTHOR_ROWS}) a "
    f"JOIN {NAMES} n ON n.k = a.k AND n.i = a.i "
    f"LEFT JOIN {catalogue('author_position')} p ON p.v = a.position "
    f"LEFT JOIN {catalogue('raw_author_name')} r ON r.v = n.v"
)
EXPECTED["work_author_country"] = (
    f"SELECT k AS work_id, {big('i')} AS author_seq, CAST(1 AS BIGINT) AS country_seq, {fx.COUNTRY_1} AS country_iso_alpha2_code FROM {AUTHOR_ROWS} "
    f"UNION ALL SELECT k, i, 4, {fx.COUNTRY_4} FROM {AUTHOR_ROWS}"
)
_LINK = f"SELECT k, i, {{o}} AS o, {{a}} AS a, {{n}} AS n FROM {AUTHOR_ROWS} WHERE (k + i) % 3 {{mode}} 0"
LINK_ROWS = "(" + " UNION ALL ".join(
    _LINK.format(o=o, a=a, n=n, mode=mode)
    for o, a, n, mode in (
        (1, "1", "100 * i + 1", "="), (2, "1", "100 * i + 2", "="), (3, "i + 1", "k % 50", "="),
        (1, "1", "100 * i + 5", "<>"), (2, "i + 1", "100 * i + 6", "<>"), (3, "i + 1", "100 * i + 7", "<>"),
    )
) + ")"
EXPECTED["work_affiliation_institution"] = (
    f"SELECT k AS work_id, {big('a')} AS affiliation_seq, row_number() OVER (PARTITION BY k, a ORDER BY i, o) AS institution_seq, "
    f"{big('n')} AS institution_id FROM {LINK_ROWS}"
)
EXPECTED["work_data_source"] = (
    f"SELECT k AS work_id, row_number() OVER (PARTITION BY k ORDER BY o) AS data_source_seq, c.id AS data_source_id "
    f"FROM {SOURCE_NAMES} s JOIN {catalogue('data_source')} c ON c.v = s.v"
)
EXPECTED["work_grant"] = (
    f"SELECT k AS work_id, {big('i')} AS grant_seq, award_id, {num('funder')} AS funder_id FROM {elements('works', 'grants')}"
)
REFERENCES = f"(SELECT k, i, {num('v')} AS n FROM {elements('works', 'referenced_works')})"
EXPECTED["work_reference"] = f"SELECT k AS work_id, {big('i')} AS reference_seq, n AS cited_work_id FROM {REFERENCES}"
EXPECTED["work_related"] = (
    f"SELECT k AS work_id, {big('i')} AS related_work_seq, {num('v')} AS related_work_id FROM {elements('works', 'related_works')}"
)
_SHARED = (
    f"(SELECT DISTINCT k, {fx.AUTHOR_ID} AS a FROM {AUTHOR_ROWS})"
)
CITATION = f"""
SELECT r.k AS citing_work_id, {big('r.i')} AS reference_seq, r.n AS cited_work_id, {big('x.d_publication_year')} AS pub_year,
  {big('x.d_publication_year - y.d_publication_year')} AS cit_window,
  CASE WHEN y.k IS NOT NULL THEN {big('s.k IS NOT NULL')} END AS is_self_cit
FROM {REFERENCES} r JOIN {W} x ON x.k = r.k LEFT JOIN {W} y ON y.k = r.n
LEFT JOIN (SELECT DISTINCT p.k, p.n FROM {REFERENCES} p JOIN {_SHARED} a ON a.k = p.k JOIN {_SHARED} b ON b.k = p.n AND b.a = a.a) s
  ON s.k = r.k AND s.n = r.n"""
EXPECTED["citation"] = CITATION
EXPECTED["work_detail"] = f"""
SELECT w.k AS work_id, n.author_first, n.author_et_al, 'Inst ' || (w.k % 50) AS institution_first,
  'Inst 51; Inst 61' AS institution_et_al, {TITLE} AS title,
  CASE WHEN w.k % 14 <> 0 THEN 'Source ' || (w.k % 97) END AS source, {big('d_publication_year')} AS pub_year,
  d_biblio_volume AS volume, d_biblio_issue AS issue,
  CASE WHEN d_biblio_last_page IS NULL THEN d_biblio_first_page ELSE d_biblio_first_page || '-' || d_biblio_last_page END AS pages,
  CASE w.k % 6 WHEN 0 THEN '10.1/A' || w.k WHEN 1 THEN 'http://dx.doi.org/10.1/B' || w.k ELSE '10.2/C' || w.k END AS doi,
  CASE w.k % 8 WHEN 0 THEN w.k + 10000 WHEN 1 THEN w.k WHEN 2 THEN 100 + w.k % 900 END AS pmid,
  d_type AS work_type, {big('d_cited_by_count')} AS n_cits, coalesce(c.n, 0) AS n_self_cits
FROM {W} w
JOIN (SELECT k, max(CASE WHEN i = 1 THEN v END) AS author_first,
        coalesce(string_agg(CASE WHEN i > 1 THEN v END, '; ' ORDER BY i), '') AS author_et_al
      FROM (SELECT k, i, coalesce(nullif({fx.NAME}, ''), nullif({fx.DISPLAY}, '')) AS v FROM {AUTHOR_ROWS}) GROUP BY k) n ON n.k = w.k
LEFT JOIN (SELECT cited_work_id, count(*) AS n FROM ({CITATION}) WHERE is_self_cit = 1 GROUP BY 1) c ON c.cited_work_id = w.k"""

# --- authors -----------------------------------------------------------------

EXPECTED["author"] = f"""
SELECT k AS author_id, d_display_name AS author,
  CASE k % 6 WHEN 0 THEN '0000-0002-1825-' || (1000 + k % 9000) WHEN 1 THEN '0000-0002-1825-009X'
    WHEN 2 THEN '0000-0002-1825-' || (1000 + k % 9000) WHEN 4 THEN '0000-0001-0000-' || (1000 + k % 9000) END AS orcid,
  CASE WHEN k % 4 IN (0, 1) THEN k END AS scopus_id, d_ids_wikipedia AS wikipedia_url, {short_and_dates()}
FROM {raw('authors')}"""
EXPECTED["author_alternative_name"] = (
    f"SELECT k AS author_id, {big('min(i)')} AS alternative_name_seq, v AS alternative_name "
    f"FROM {elements('authors', 'display_name_alternatives')} WHERE v <> '' GROUP BY k, v"
)
_AFFILIATED = (
    f"(SELECT k, i, k + i % 3 AS n, row_number() OVER (PARTITION BY k ORDER BY i) AS seq "
    f"FROM {elements('authors', 'affiliations')} WHERE (k + i) % 5 <> 0)"
)
EXPECTED["author_institution"] = f"SELECT k AS author_id, seq AS institution_seq, n AS institution_id FROM {_AFFILIATED}"
EXPECTED["author_institution_year"] = (
    f"SELECT k AS author_id, seq AS institution_seq, CAST(1 AS BIGINT) AS year_seq, {big('2000 + i')} AS year FROM {_AFFILIATED} "
    f"UNION ALL SELECT k, seq, 2, 2010 + k % 9 FROM {_AFFILIATED}"
)
EXPECTED["author_last_known_institution"] = (
    "SELECT k AS author_id, row_number() OVER (PARTITION BY k ORDER BY i) AS last_known_institution_seq, "
    "n AS last_known_institution_id FROM (SELECT k, n, min(i) AS i FROM ("
    f"SELECT k, 0 AS i, k % 3 AS n FROM {rows('authors')} WHERE k % 3 = 0 "
    f"UNION ALL SELECT k, i, (k + i) % 3 FROM {elements('authors', 'last_known_institutions')} WHERE (k + i) % 5 <> 0"
    ") GROUP BY k, n)"
)

# --- institutions ------------------------------------------------------------

EXPECTED["institution"] = f"""
SELECT k AS institution_id, d_display_name AS institution, t.id AS institution_type_id, d_country_code AS country_iso_alpha2_code,
  r.id AS region_id, {whole('d_geo_geonames_city_id')} AS geonames_city_id, TRY_CAST(d_geo_latitude AS DOUBLE) AS latitude,
  TRY_CAST(d_geo_longitude AS DOUBLE) AS longitude, d_homepage_url AS homepage_url, {flag('d_is_super_system')} AS is_super_system,
  {segment('d_ror')} AS ror_id, d_ids_grid AS grid_id, {whole('d_ids_mag')} AS mag_id, {segment('d_ids_wikidata')} AS wikidata_id,
  d_ids_wikipedia AS wikipedia_url, d_image_url AS image_url, d_image_thumbnail_url AS thumbnail_url, {short_and_dates()}
FROM {INST} LEFT JOIN {catalogue('institution_type')} t ON t.v = trim(d_type)
LEFT JOIN {catalogue('region')} r ON r.v = trim(d_geo_region)"""
EXPECTED["city"] = (
    "SELECT g AS geonames_city_id, d_geo_city AS city FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k) AS rn "
    f"FROM (SELECT *, {whole('d_geo_geonames_city_id')} AS g FROM {INST}) WHERE g <> 0 AND d_geo_city <> '') WHERE rn = 1"
)
EXPECTED["country"] = (
    "SELECT d_country_code AS country_iso_alpha2_code, d_geo_country AS country FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY d_country_code ORDER BY k) AS rn FROM {INST} WHERE d_country_code <> '') WHERE rn = 1"
)
EXPECTED["institution_acronym"] = names("institutions", "display_name_acronyms", "institution_id", "acronym_seq", "acronym")
EXPECTED["institution_alternative_name"] = names(
    "institutions", "display_name_alternatives", "institution_id", "alternative_name_seq", "alternative_name")
EXPECTED["institution_international_name"] = f"""
SELECT k AS institution_id, 'fr' AS language_code, 'Nom ' || k AS institution_international_name FROM {rows('institutions')}
UNION ALL SELECT k, 'de', 'Name ' || k FROM {rows('institutions')} WHERE k % 2 <> 0
UNION ALL SELECT k, 'en', 'Name' FROM {rows('institutions')} WHERE k % 3 <> 0"""
EXPECTED["institution_associated"] = (
    "SELECT a.k AS institution_id, a.seq AS associated_institution_seq, a.n AS associated_institution_id, "
    "c.id AS institution_relationship_type_id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) AS seq FROM "
    f"(SELECT *, {num('id')} AS n FROM {elements('institutions', 'associated_institutions')}) WHERE n IS NOT NULL) a "
    f"LEFT JOIN {catalogue('institution_relationship_type')} c ON c.v = a.relationship"
)
for _entity, _owner, _kinds in (("institutions", "institution", ("funder", "publisher")), ("funders", "funder", ("publisher",))):
    for _kind in _kinds:
        EXPECTED[f"{_owner}_{_kind}"] = ids(
            _entity, "roles", f"{_owner}_id", f"{_kind}_seq", f"{_kind}_id", "id", f"role = '{_kind}'")
EXPECTED["institution_repository"] = ids(
    "institutions", "repositories", "institution_id", "repository_seq", "repository_source_id", "id")
EXPECTED["institution_lineage"] = ids(
    "institutions", "lineage", "institution_id", "lineage_institution_seq", "lineage_institution_id")

# --- concepts ----------------------------------------------------------------

CONCEPT_ROWS = rows("concepts")
EXPECTED["concept"] = f"""
SELECT k AS concept_id, d_display_name AS concept, d_description AS description, {big('d_level')} AS level,
  {whole('d_ids_mag')} AS mag_id, {segment("coalesce(nullif(d_ids_wikidata, ''), d_wikidata)")} AS wikidata_id,
  d_ids_wikipedia AS wikipedia_url, d_image_url AS image_url, d_image_thumbnail_url AS thumbnail_url, {short_and_dates()}
FROM {raw('concepts')}"""
EXPECTED["concept_ancestor"] = f"""
SELECT k AS concept_id, CAST(1 AS BIGINT) AS ancestor_concept_seq, k + 1 AS ancestor_concept_id FROM {CONCEPT_ROWS} WHERE k % 3 = 0
UNION ALL SELECT k, 2, k + 2 FROM {CONCEPT_ROWS} WHERE k % 3 = 0
UNION ALL SELECT k, 3, 3 FROM {CONCEPT_ROWS} WHERE k % 3 = 0
UNION ALL SELECT k, 1, k FROM {CONCEPT_ROWS} WHERE k % 3 = 1"""
EXPECTED["concept_international_name"] = (
    f"SELECT k AS concept_id, 'en' AS language_code, p_name AS concept_international_name FROM {CONCEPT_ROWS}"
)
EXPECTED["concept_international_description"] = (
    f"SELECT k AS concept_id, 'en' AS language_code, p_type AS concept_international_description FROM {CONCEPT_ROWS} "
    f"UNION ALL SELECT k, 'fr', 'fr ' || p_type FROM {CONCEPT_ROWS} WHERE k % 2 <> 0"
)
EXPECTED["concept_related"] = ids(
    "concepts", "related_concepts", "concept_id", "related_concept_seq", "related_concept_id", "id", more=", score")
for _code, _lists in (
    ("cui", [("k % 3 = 0", "'C' || k"), ("k % 3 = 0", "'C' || k"), ("k % 3 = 0", "'CX'"), ("k % 3 = 1", "'C1'")]),
    ("aui", [("k % 4 = 0", "'A' || k"), ("k % 4 = 0", "'A9'"), ("k % 4 <> 0", "'A7'")]),
):
    EXPECTED[f"concept_umls_{_code}"] = (
        f"WITH r AS (SELECT * FROM {CONCEPT_ROWS} WHERE k % 16 <> 0) "
        f"SELECT k AS concept_id, row_number() OVER (PARTITION BY k ORDER BY i) AS umls_{_code}_seq, v AS umls_{_code} "
        f"FROM {listed(_lists)}"
    )

# --- sources -----------------------------------------------------------------

EXPECTED["source"] = f"""
SELECT k AS source_id, d_display_name AS source, d_abbreviated_title AS abbreviation, t.id AS source_type_id,
  d_country_code AS country_iso_alpha2_code,
  CASE WHEN k % 5 = 0 THEN k WHEN k % 2 = 0 THEN k + 7 END AS host_organization_publisher_id,
  CASE WHEN k % 5 = 1 THEN k END AS host_organization_institution_id, d_homepage_url AS homepage_url,
  CASE k % 4 WHEN 0 THEN {fx.ISSN_1} || '-567X' WHEN 1 THEN NULL ELSE {fx.ISSN_1} || '-0000' END AS issn_l,
  {whole('d_ids_mag')} AS mag_id, {segment('d_ids_wikidata')} AS wikidata_id, {segment('d_ids_fatcat')} AS fatcat_id,
  {big('d_is_in_doaj')} AS is_in_doaj, {flag('d_is_oa')} AS is_oa, {whole('d_apc_usd')} AS apc_price_usd, {short_and_dates()}
FROM {raw('sources')} LEFT JOIN {catalogue('source_type')} t ON t.v = d_type"""
EXPECTED["source_alternative_title"] = names(
    "sources", "alternate_titles", "source_id", "alternative_title_seq", "alternative_title")
EXPECTED["source_apc_price"] = (
    f"SELECT k AS source_id, row_number() OVER (PARTITION BY k ORDER BY i) AS apc_price_seq, {big('price')} AS apc_price, currency "
    f"FROM {elements('sources', 'apc_prices')} WHERE price IS NOT NULL AND currency <> ''"
)
_ISSN_OF = f"CASE WHEN v <> 'none' THEN {fx.ISSN_1} || '-222X' END"
EXPECTED["source_issn"] = (
    f"SELECT k AS source_id, CAST(1 AS BIGINT) AS issn_seq, x AS issn FROM (SELECT DISTINCT k, {_ISSN_OF} AS x "
    f"FROM {elements('sources', 'issn')}) WHERE x IS NOT NULL "
    f"UNION ALL SELECT k, 1, {fx.ISSN_1} || '-1111' FROM {rows('sources')} WHERE k % 4 = 0"
)
EXPECTED["source_society"] = (
    "SELECT k AS source_id, row_number() OVER (PARTITION BY k ORDER BY i) AS society_seq, society, url AS homepage_url FROM "
    f"(SELECT *, coalesce(nullif(organization, ''), name) AS society FROM {elements('sources', 'societies')}) "
    "WHERE society IS NOT NULL OR url IS NOT NULL"
)

# --- funders, publishers -----------------------------------------------------

_PICTURES = f"d_image_url AS image_url, d_image_thumbnail_url AS thumbnail_url, {short_and_dates()}"
EXPECTED["funder"] = f"""
SELECT k AS funder_id, d_display_name AS funder, d_country_code AS country_iso_alpha2_code, d_description AS description,
  d_homepage_url AS homepage_url, {segment('coalesce(d_ids_ror, d_ror)')} AS ror_id, {segment('d_ids_wikidata')} AS wikidata_id,
  {_PICTURES} FROM {raw('funders')}"""
EXPECTED["funder_alternative_name"] = names("funders", "alternate_titles", "funder_id", "alternative_name_seq", "alternative_name")
EXPECTED["publisher"] = f"""
SELECT k AS publisher_id, d_display_name AS publisher, {big('d_hierarchy_level')} AS hierarchy_level,
  CASE WHEN k % 3 = 0 THEN k + 1 END AS parent_publisher_id, d_homepage_url AS homepage_url, {segment('d_ids_ror')} AS ror_id,
  {segment('d_ids_wikidata')} AS wikidata_id, {_PICTURES} FROM {raw('publishers')}"""
EXPECTED["publisher_alternative_name"] = names(
    "publishers", "alternate_titles", "publisher_id", "alternative_name_seq", "alternative_name")
EXPECTED["publisher_country"] = names("publishers", "country_codes", "publisher_id", "country_seq", "country_iso_alpha2_code")

# --- taxonomy ----------------------------------------------------------------

for _level, _above, _below in (
    ("domain", (), "field"), ("field", ("domain",), "subfield"), ("subfield", ("domain", "field"), "topic"),
    ("topic", ("domain", "field", "subfield"), None),
):
    _entity, _key = f"{_level}s", f"{_level}_id"
    _wikidata = f"{segment('d_ids_wikidata')} AS wikidata_id, " if _below else ""
    _ups = "".join(f"{num(f'd_{a}_id')} AS {a}_id, " for a in _above)
    EXPECTED[_level] = (
        f"SELECT k AS {_key}, d_display_name AS {_level}, d_description AS description, k AS {SHORT_ID}, {_wikidata}"
        f"d_ids_wikipedia AS wikipedia_url, {_ups}{dates()} FROM {raw(_entity)}"
    )
    EXPECTED[f"{_level}_sibling"] = ids(_entity, "siblings", _key, f"sibling_{_level}_seq", f"sibling_{_level}_id", "id")
    if _below:
        EXPECTED[f"{_level}_alternative_name"] = names(
            _entity, "display_name_alternatives", _key, "alternative_name_seq", "alternative_name")
        EXPECTED[f"{_level}_{_below}"] = ids(_entity, f"{_below}s", _key, f"{_below}_seq", f"{_below}_id")
    else:
        EXPECTED["topic_keyword"] = (
            f"SELECT k AS topic_id, row_number() OVER (PARTITION BY k ORDER BY i) AS keyword_seq, v AS keyword "
            f"FROM {elements('topics', 'keywords')} WHERE v <> ''"
        )

# The abstract comes from the documents table; see the operator queries.

_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def collapsed(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{_SPACES}', ' ', 'g'), ' '), '')"


EXPECTED["work_abstract"] = (
    f"SELECT * FROM (SELECT doc_id AS work_id, {collapsed('text')} AS abstract FROM documents) WHERE abstract IS NOT NULL"
)
