"""Registered queries for single operators and functions, over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.fixed import ID_URL_PREFIX as URL
from starfold.functions import arrays as A
from starfold.functions import text as X
from starfold.operators.catalogue import Catalogue, CatalogueConfig, collect, missing
from starfold.operators.checks import column_problems, null_keys, repeated_keys
from starfold.operators.dense_ids import dense_ids
from starfold.operators.diff import merge_outputs, table_diff
from starfold.operators.first_wins import first_wins
from starfold.plans import works
from starfold.plans.derived import shortened
from starfold.plans.job import Options, report_frame, stage, uncatalogued
from starfold.plans.registry import FEEDS
from starfold.plans.tables import conform, output_columns
from starfold.session import shared_folder, spread
from starfold.sinks.delimited import formatted, save_catalogue, write_delimited
from starfold.sources.catalogue_files import load_catalogue
from starfold.sources.documents import documents, malformed
from starfold.sources.snapshot import chosen_entities, merged_ids, scan, without_merged

from .expected import collapsed, numbers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        SQL[name] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/query-{uuid.uuid4().hex}"


C = F.col
BIG = "CAST({} AS BIGINT)".format

# --- scalar functions --------------------------------------------------------


@query("q_text_normalise", f"SELECT doc_id, {collapsed('text')} AS cleaned FROM documents")
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X16."""
    return read(spark, sf_dir, "documents").select("doc_id", X.collapse_spaces(C("text")).alias("cleaned"))


@query("q_html_normalise", f"SELECT page_id, {collapsed('html')} AS cleaned FROM pages")
def html_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", X.collapse_spaces(C("html")).alias("cleaned"))


@query(
    "q_ids",
    "SELECT c_custkey, nullif(CASE c_custkey % 5 WHEN 0 THEN 'A' || c_custkey WHEN 1 THEN c_name WHEN 2 THEN 'domains/' || c_custkey "
    "WHEN 3 THEN '' ELSE 'A' || c_custkey || 'x' END, '') AS short_id, "
    "CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN c_custkey END AS number FROM customer",
)
def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2 on five forms of id."""
    raw = F.expr(
        f"CASE c_custkey % 5 WHEN 0 THEN '  {URL}A' || c_custkey WHEN 1 THEN c_name || '\\t' "
        f"WHEN 2 THEN '{URL}domains/' || c_custkey WHEN 3 THEN '{URL}' ELSE 'A' || c_custkey || 'x' END"
    )
    return read(spark, sf_dir, "customer").select(
        "c_custkey", X.short_id(raw).alias("short_id"), X.id_number(raw).alias("number")
    )


@query(
    "q_longest_number",
    "SELECT page_id, CAST((SELECT arg_max(r, length(r) * 1000 + i) FROM (SELECT unnest(list) AS r, unnest(range(len(list))) AS i "
    "FROM (SELECT regexp_extract_all(url, '[0-9]+') AS list))) AS BIGINT) AS longest, "
    "CASE page_id % 3 WHEN 0 THEN page_id WHEN 1 THEN 7890 ELSE page_id + 1000000 END AS made FROM pages",
)
def longest_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X8."""
    made = F.expr(
        "CASE page_id % 3 WHEN 0 THEN ' ' || page_id WHEN 1 THEN 'a 3456 x 7890 12' "
        "ELSE 'id 55 of ' || (page_id + 1000000) || '/777' END"
    )
    return read(spark, sf_dir, "pages").select(
        "page_id", X.longest_number(C("url")).alias("longest"), X.longest_number(made).alias("made")
    )


@query(
    "q_last_segment",
    "SELECT page_id, nullif(regexp_extract(rtrim(url, '/'), '[^/]*$'), '') AS segment, "
    "TRY_CAST(nullif(regexp_extract(rtrim('http://goals/' || page_id || '/', '/'), '[^/]*$'), '') AS BIGINT) AS goal FROM pages",
)
def last_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11, X15, X18."""
    goal = F.concat(F.lit("http://goals/"), C("page_id"), F.lit("/"))
    return read(spark, sf_dir, "pages").select(
        "page_id", X.last_segment(C("url")).alias("segment"), X.segment_number(goal).alias("goal")
    )


_FORM = "event_id % 6"


@query(
    "q_dates",
    f"SELECT event_id, CASE {_FORM} WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 4 THEN 'soon' WHEN 5 THEN NULL "
    "ELSE strftime(ts, '%Y-%m-%d') END AS as_text, "
    f"CASE {_FORM} WHEN 4 THEN 'soon' WHEN 5 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day_text, "
    f"CASE WHEN {_FORM} < 4 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events",
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4, X5 on a fraction, a time, a day, a zone, no date and null."""
    raw = F.expr(
        f"CASE {_FORM} WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") "
        "WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 2 THEN date_format(ts, 'yyyy-M-d') "
        "WHEN 3 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") WHEN 4 THEN 'soon' END"
    )
    return read(spark, sf_dir, "events").select(
        "event_id", X.iso_date_text(raw).alias("as_text"), X.iso_day_text(raw).alias("day_text"),
        F.date_format(X.day(raw), "yyyy-MM-dd").alias("day"),
    )


@query(
    "q_casts",
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE -c_custkey END AS whole, "
    "CAST(trunc(c_acctbal) AS BIGINT) AS of_number, "
    "CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS DOUBLE) WHEN 1 THEN c_custkey + 0.5 WHEN 2 THEN NULL ELSE -c_custkey END AS decimal, "
    "CASE c_custkey % 12 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 6 THEN 0 "
    "WHEN 7 THEN 0 WHEN 8 THEN 0 WHEN 9 THEN 0 END AS flag, CAST(c_custkey % 3 <> 0 AS INTEGER) AS flag_of_number FROM customer",
)
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6, X7, X10."""
    number = F.expr(
        "CASE c_custkey % 4 WHEN 0 THEN ' ' || c_custkey || ' ' WHEN 1 THEN c_custkey || '.5' WHEN 2 THEN 'many' ELSE '-' || c_custkey END"
    )
    word = F.expr(
        "CASE c_custkey % 12 WHEN 0 THEN 'True' WHEN 1 THEN 't' WHEN 2 THEN '1' WHEN 3 THEN ' YES ' WHEN 4 THEN 'y' WHEN 5 THEN 'FALSE' "
        "WHEN 6 THEN 'f' WHEN 7 THEN '0' WHEN 8 THEN 'No' WHEN 9 THEN 'n' WHEN 10 THEN 'on' END"
    )
    return read(spark, sf_dir, "customer").select(
        "c_custkey", X.whole_number(number).alias("whole"), X.whole_of_number(C("c_acctbal")).alias("of_number"),
        X.decimal_number(number).alias("decimal"), X.flag(word).cast("int").alias("flag"),
        X.flag_of_number(C("c_custkey") % 3).cast("int").alias("flag_of_number"),
    )


@query(
    "q_language",
    "SELECT doc_id, nullif(lower(substr(lang, 1, 2)), '') AS code, CASE doc_id % 3 WHEN 0 THEN lang END AS made FROM documents",
)
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9."""
    made = F.expr("CASE doc_id % 3 WHEN 0 THEN upper(lang) || '-XX' WHEN 1 THEN '' END")
    return read(spark, sf_dir, "documents").select(
        "doc_id", X.language_code(C("lang")).alias("code"), X.language_code(made).alias("made")
    )


_TAIL = "(1000 + c_custkey % 9000)"


@query(
    "q_patterns",
    f"SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '0000-0002-1825-' || {_TAIL} WHEN 1 THEN '0000-0002-1825-' || {_TAIL} "
    f"WHEN 2 THEN '0000-0002-1825-009X' WHEN 3 THEN '0000-0002-1825-' || {_TAIL} END AS orcid, "
    f"CASE c_custkey % 4 WHEN 0 THEN {_TAIL} || '-567X' WHEN 1 THEN {_TAIL} || '-5678' END AS issn, "
    "CASE c_custkey % 4 WHEN 0 THEN '10.1/Ab' || c_custkey WHEN 1 THEN 'http://dx.doi.org/10.1/' || c_custkey "
    "WHEN 2 THEN 'doi:' || c_custkey END AS doi, "
    "CASE WHEN c_custkey % 3 < 2 THEN c_custkey END AS scopus, "
    "CASE c_custkey % 3 WHEN 0 THEN 'Q' || c_custkey WHEN 1 THEN 'Q7' END AS wikidata FROM customer",
)
def patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11, X12, X13, X14, X17."""
    def e(text: str):
        return F.expr(text)

    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        X.orcid(e(
            f"CASE c_custkey % 5 WHEN 0 THEN 'https://orcid.org/0000-0002-1825-' || {_TAIL} WHEN 1 THEN 'at 000000021825' || {_TAIL} || ' here' "
            f"WHEN 2 THEN '000000021825009x' WHEN 3 THEN '0000 0002 1825 ' || {_TAIL} ELSE '00000002182500' END")).alias("orcid"),
        X.issn(e(
            f"CASE c_custkey % 4 WHEN 0 THEN 'urn:issn:' || {_TAIL} || '-567x' WHEN 1 THEN 'ISSN ' || {_TAIL} || '-5678 p' "
            f"WHEN 2 THEN {_TAIL} || '567X' ELSE '' END")).alias("issn"),
        X.doi(e(
            "CASE c_custkey % 4 WHEN 0 THEN ' HTTPS://DOI.ORG/10.1/Ab' || c_custkey WHEN 1 THEN 'http://dx.doi.org/10.1/' || c_custkey "
            "WHEN 2 THEN 'doi:' || c_custkey ELSE '' END")).alias("doi"),
        X.scopus_author(e(
            "CASE c_custkey % 3 WHEN 0 THEN 'http://x/?AUTHORid=' || c_custkey || '&p=1' WHEN 1 THEN ' ' || c_custkey ELSE 'n' || c_custkey END"
        )).alias("scopus"),
        X.last_segment(e(
            "CASE c_custkey % 3 WHEN 0 THEN 'https://www.wikidata.org/wiki/Q' || c_custkey || '//' WHEN 1 THEN ' Q7 ' ELSE ' ' END"
        )).alias("wikidata"),
    )


@query(
    "q_host_split",
    "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_suppkey WHEN 1 THEN s_suppkey + 1 WHEN 2 THEN s_suppkey + 1 END AS publisher, "
    "CASE WHEN s_suppkey % 4 = 1 THEN s_suppkey END AS institution FROM supplier",
)
def host_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19."""
    host = F.expr(f"CASE s_suppkey % 4 WHEN 0 THEN '{URL}P' || s_suppkey WHEN 1 THEN 'I' || s_suppkey WHEN 2 THEN 'X1' END")
    other = F.expr("CASE s_suppkey % 4 WHEN 3 THEN 'I9' ELSE 'P' || (s_suppkey + 1) END")
    return read(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.coalesce(X.id_with_letter(host, "P"), X.id_with_letter(other, "P")).alias("publisher"),
        X.id_with_letter(host, "I").alias("institution"),
    )


@query(
    "q_first_filled",
    "SELECT doc_id, coalesce(CASE WHEN doc_id % 2 <> 0 THEN lang END, CASE WHEN doc_id % 3 <> 0 THEN source END) AS chosen, "
    "translate(coalesce(CASE WHEN doc_id % 2 <> 0 THEN 'a_' || lang END, 'other'), '_', '-') AS kind, "
    "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN doc_id || '-' || (doc_id + 9) ELSE CAST(doc_id AS VARCHAR) END AS pages FROM documents",
)
def first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, F8, X23."""
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        X.first_filled(
            F.expr("CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END"), F.expr("CASE WHEN doc_id % 3 <> 0 THEN source END")
        ).alias("chosen"),
        F.translate(
            F.coalesce(X.filled(F.expr("CASE WHEN doc_id % 2 = 0 THEN '' ELSE 'a_' || lang END")), F.lit("other")), "_", "-"
        ).alias("kind"),
        X.page_range(
            F.expr("CASE WHEN doc_id % 3 <> 0 THEN '' || doc_id ELSE '' END"),
            F.expr("CASE WHEN doc_id % 3 = 1 THEN '' || (doc_id + 9) ELSE '' END"),
        ).alias("pages"),
    )


@query(
    "q_json_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
    "nullif(trim(json_extract_string(props, '$.k')), '') AS k_text FROM events",
)
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3, X6 on parsed objects."""
    props = F.from_json("props", "map<string,string>")
    return read(spark, sf_dir, "events").select(
        "event_id", X.whole_number(X.map_text(props, "k")).alias("k"), X.map_text(props, "k").alias("k_text")
    )


@query(
    "q_object_equality",
    "SELECT event_id, CAST(event_id % 3 = 0 AS INTEGER) AS same FROM events",
)
def object_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key order does not matter, a key that is null does."""
    one = F.expr("'{\"id\":' || event_id || ',\"kind\":\"' || event_type || '\",\"props\":' || props || '}'")
    other = F.expr(
        "CASE event_id % 3 WHEN 0 THEN '{\"props\":' || props || ', \"kind\":\"' || event_type || '\",\"id\":' || event_id || '}' "
        "WHEN 1 THEN '{\"props\":' || props || ', \"kind\":\"' || event_type || '\",\"x\":null,\"id\":' || event_id || '}' "
        "ELSE '{\"id\":' || event_id || ',\"props\":' || props || '}' END"
    )
    return read(spark, sf_dir, "events").select(
        "event_id", (X.canonical_object(one) == X.canonical_object(other)).cast("int").alias("same")
    )


# --- sequences over real texts -----------------------------------------------

_WORDS = r"regexp_split_to_array(text, '\n')"


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.split("text", "\n").alias("parts"))


_LINE_ROWS = f"(SELECT doc_id, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {_WORDS} AS l FROM documents))"


@query("q_seq_positional", f"SELECT doc_id, i AS seq, v AS line FROM {_LINE_ROWS} WHERE v <> ''")
def seq_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in the whole list, gaps where elements are dropped."""
    rows = A.numbered(text_lines(spark, sf_dir), ["doc_id"], C("parts"), "seq", "line")
    return rows.where(X.filled(C("line")).isNotNull()).select("doc_id", C("seq").cast("bigint").alias("seq"), "line")


@query(
    "q_seq_dense",
    f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq, v AS line FROM {_LINE_ROWS} WHERE v <> ''",
)
def seq_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, F3."""
    rows = A.numbered(text_lines(spark, sf_dir), ["doc_id"], A.present(C("parts")), "seq", "line")
    return rows.select("doc_id", C("seq").cast("bigint").alias("seq"), "line")


_FIRST_LINES = f"(SELECT doc_id, v, min(i) AS i FROM {_LINE_ROWS} WHERE v <> '' GROUP BY doc_id, v)"


@query(
    "q_seq_dense_distinct",
    f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq, v AS line FROM {_FIRST_LINES}",
)
def seq_dense_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines count once."""
    rows = A.numbered(text_lines(spark, sf_dir), ["doc_id"], A.dense_distinct(C("parts")), "seq", "line")
    return rows.select("doc_id", C("seq").cast("bigint").alias("seq"), "line")


@query("q_seq_positional_distinct", f"SELECT doc_id, i AS seq, v AS line FROM {_FIRST_LINES}")
def seq_positional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4."""
    rows = text_lines(spark, sf_dir).select("doc_id", F.explode(A.first_positions(C("parts"))).alias("e"))
    return rows.select("doc_id", C("e.seq").cast("bigint").alias("seq"), C("e.item").alias("line"))


@query(
    "q_seq_nested",
    f"SELECT doc_id, seq, j AS word_seq, w AS word FROM (SELECT doc_id, seq, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS j FROM "
    f"(SELECT doc_id, seq, list_filter(string_split(v, ' '), lambda x: x <> '') AS l FROM "
    f"(SELECT doc_id, v, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq FROM {_LINE_ROWS} WHERE v <> '')))",
)
def seq_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text, words of a line."""
    lines = A.numbered(text_lines(spark, sf_dir), ["doc_id"], A.present(C("parts")), "seq", "line")
    rows = A.numbered(lines, ["doc_id", "seq"], A.present(F.split("line", " ")), "word_seq", "word")
    return rows.select("doc_id", C("seq").cast("bigint").alias("seq"), C("word_seq").cast("bigint").alias("word_seq"), "word")


@query(
    "q_name_list",
    "SELECT doc_id, CASE WHEN len(l) > 4 THEN l[1] || '; ' || l[2] || '; ' || l[3] || '; ...; ' || l[len(l)] "
    f"ELSE array_to_string(l, '; ') END AS names FROM (SELECT doc_id, list_filter({_WORDS}, lambda x: x <> '') AS l FROM documents)",
)
def name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6."""
    return text_lines(spark, sf_dir).select("doc_id", shortened(A.present(C("parts"))).alias("names"))


@query(
    "q_affiliation_texts",
    f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS seq, v AS label FROM (SELECT doc_id, i, {collapsed('v')} AS v FROM "
    "(SELECT doc_id, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS i FROM "
    f"(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {_WORDS} ELSE string_split(replace(text, '.', ';'), ';') END AS l FROM documents))) WHERE v IS NOT NULL",
)
def affiliation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cleaned list, or one text split at semicolons when the list has nothing."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    many = F.when(C("doc_id") % 2 == 0, F.split("text", "\n")).otherwise(F.array(F.lit(""), F.lit(" ")))
    one = F.translate("text", ".", ";")
    rows = A.numbered(docs, ["doc_id"], X.affiliation_texts(many, one), "seq", "label")
    return rows.select("doc_id", C("seq").cast("bigint").alias("seq"), "label")


# --- catalogues --------------------------------------------------------------

_EVENT_VALUES = "SELECT event_type AS v FROM events"
_WORD_ROWS = "(SELECT doc_id, unnest(list_filter(string_split(text, ' '), lambda x: x <> '')) AS v FROM documents)"


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.explode(A.present(F.split("text", " "))).alias("value"))


def catalogue_of(values: DataFrame, name: str) -> Catalogue:
    """A catalogue from one text column."""
    assigned, sizes = dense_ids(values.select(F.lit(name).alias("catalogue"), "value").where("value <> ''").distinct())
    return Catalogue(assigned, sizes, fresh=True)


_FOLDED_WORDS = (
    f"(SELECT v, row_number() OVER (ORDER BY replace(lower(v), 'ß', 'ss'), v) AS id FROM (SELECT DISTINCT v FROM {_WORD_ROWS}))"
)


@query("q_namespace_ids", f"SELECT v AS value, id FROM {_FOLDED_WORDS}")
def namespace_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, O1: every distinct word of every text, numbered in folded order."""
    return catalogue_of(words(spark, sf_dir), "keyword").part("keyword")


@query(
    "q_namespace_lookup",
    f"SELECT w.doc_id, f.id, count(*) AS n FROM {_WORD_ROWS} w JOIN {_FOLDED_WORDS} f ON f.v = w.v GROUP BY 1, 2",
)
def namespace_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of every word; the counts make hot words visible."""
    found = words(spark, sf_dir)
    rows = catalogue_of(found, "keyword").lookup(found, "keyword", C("value"), "id")
    return rows.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_enum_lookup",
    f"SELECT e.event_id, c.id FROM events e LEFT JOIN {numbers(_EVENT_VALUES)} c "
    "ON c.v = CASE WHEN e.event_id % 5 <> 0 THEN e.event_type END",
)
def enum_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed values; blank ones have no id."""
    events = read(spark, sf_dir, "events")
    catalogue = catalogue_of(events.select(C("event_type").alias("value")), "license")
    raw = F.when(C("event_id") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "event_type", F.lit("\t")))
    return catalogue.lookup(events, "license", raw, "id").select("event_id", "id")


@query(
    "q_tolerant_lookup",
    "SELECT n.n_nationkey, s.s_suppkey, r.id FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region g ON g.r_regionkey = n.n_regionkey "
    f"LEFT JOIN {numbers('SELECT r_name AS v FROM region WHERE r_regionkey <> 2')} r ON r.v = g.r_name",
)
def tolerant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region the catalogue lacks gives null, not an error."""
    regions = read(spark, sf_dir, "region")
    known = regions.where("r_regionkey <> 2").select(C("r_name").alias("value"))
    rows = (
        read(spark, sf_dir, "supplier")
        .join(read(spark, sf_dir, "nation"), C("s_nationkey") == C("n_nationkey"))
        .join(regions, C("n_regionkey") == C("r_regionkey"))
    )
    return catalogue_of(known, "region").lookup(rows, "region", C("r_name"), "id").select("n_nationkey", "s_suppkey", "id")


@query(
    "q_missing_values",
    "SELECT DISTINCT 'license' AS catalogue, p_name AS value FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_partkey % 40 = 0)",
)
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values in use the catalogue does not have."""
    names = read(spark, sf_dir, "part").select("p_partkey", C("p_name").alias("value"))
    stale = catalogue_of(names.where("p_partkey % 40 = 0"), "license")
    used = names.select(F.lit("license").alias("catalogue"), "value").distinct()
    return missing(used, stale)


@query(
    "q_catalogue_union",
    f"SELECT v AS value, id FROM {numbers('SELECT l_returnflag AS v FROM lineitem UNION ALL SELECT o_orderpriority FROM orders UNION ALL SELECT o_orderstatus FROM orders')}",
)
def catalogue_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue fed by several columns of several tables."""
    orders = read(spark, sf_dir, "orders")
    values = (
        read(spark, sf_dir, "lineitem").select(C("l_returnflag").alias("value")).distinct()
        .unionByName(orders.select(F.explode(F.array("o_orderpriority", "o_orderstatus")).alias("value")).distinct())
    )
    return catalogue_of(values, "license").part("license")


@query(
    "q_catalogue_reload",
    f"SELECT 'keyword' AS catalogue, v AS value, id FROM {numbers('SELECT p_name AS v FROM part')} "
    f"UNION ALL SELECT 'license', v, id FROM {numbers('SELECT c_mktsegment AS v FROM customer')}",
)
def catalogue_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved as tab-separated files, all seventeen, and loaded again."""
    values = (
        read(spark, sf_dir, "part").select(F.lit("keyword").alias("catalogue"), C("p_name").alias("value"))
        .unionByName(read(spark, sf_dir, "customer").select(F.lit("license").alias("catalogue"), C("c_mktsegment").alias("value")))
        .distinct()
    )
    assigned, sizes = dense_ids(values)
    folder = fresh_folder(spark)
    save_catalogue(Catalogue(assigned, sizes), folder)
    return load_catalogue(spark, folder).assigned.select("catalogue", "value", "id")


# --- shared dimensions, exclusion, comparison --------------------------------


@query(
    "q_first_wins",
    "SELECT l_partkey, l_shipmode, l_line FROM (SELECT l_partkey, l_returnflag || l_linestatus AS l_shipmode, "
    "CASE WHEN l_linenumber > 3 THEN l_linenumber END AS l_line, row_number() OVER (PARTITION BY l_partkey ORDER BY "
    "l_orderkey * 1000000000000 + l_linenumber * 10000000000 + l_suppkey * 100000 + CAST(l_extendedprice % 100000 AS BIGINT), l_returnflag, l_linestatus) AS rn "
    "FROM lineitem) WHERE rn = 1",
)
def first_wins_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the first row of a part wins, null attributes included."""
    order = F.expr(
        "l_orderkey * 1000000000000 + l_linenumber * 10000000000 + l_suppkey * 100000 + CAST(round(l_extendedprice % 100000) AS BIGINT)"
    )
    rows = read(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.concat("l_returnflag", "l_linestatus").alias("l_shipmode"),
        F.when(C("l_linenumber") > 3, C("l_linenumber")).alias("l_line"),
        order.alias("at"),
    )
    return first_wins(rows, ["l_partkey"], ["l_shipmode", "l_line"], "at")


@query(
    "q_drop_merged",
    "SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 7 = 0 OR o_custkey % 10 = 0 AND o_orderkey % 2 = 0) OR o_orderkey % 5 = 0",
)
def drop_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed ids are left out, records without id pass."""
    orders = read(spark, sf_dir, "orders")
    root = fresh_folder(spark)
    for name, rows in (("a", orders.where("o_orderkey % 7 = 0")), ("b", orders.where("o_custkey % 10 = 0 AND o_orderkey % 2 = 0"))):
        listed = rows.select(F.lit("2024-01-01").alias("merge_date"), F.concat(F.lit(f"{URL}W"), "o_orderkey").alias("id"))
        listed.write.option("header", True).option("compression", "gzip" if name == "a" else "none").csv(
            f"{root}/merged_ids/works/{name}"
        )
    short = F.when(C("o_orderkey") % 5 != 0, F.concat(F.lit("W"), "o_orderkey"))
    kept = without_merged(orders.select("o_orderkey", short.alias("_short")), merged_ids(spark, root, "works"))
    return kept.select("o_orderkey")


_VERSION_2 = (
    "SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 9 <> 0 "
    "UNION ALL SELECT o_custkey, 'X', o_orderpriority FROM orders WHERE o_orderkey % 9 = 1"
)
_VERSION_1 = "SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders"


@query(
    "q_table_diff",
    "SELECT o_custkey, o_orderstatus, o_orderpriority, CAST(sum(n) AS BIGINT) AS surplus FROM "
    f"(SELECT *, 1 AS n FROM ({_VERSION_1}) UNION ALL SELECT *, -1 FROM ({_VERSION_2})) GROUP BY 1, 2, 3 HAVING sum(n) <> 0",
)
def diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by which two copies differ, repeats counted."""
    orders = read(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    other = orders.where("o_orderkey % 9 <> 0").select(columns).unionByName(
        orders.where("o_orderkey % 9 = 1").select("o_custkey", F.lit("X").alias("o_orderstatus"), "o_orderpriority")
    )
    return table_diff(orders.select(columns), other)


@query("q_merge_outputs", "SELECT c_custkey, c_name, CAST(1 AS BIGINT) AS ignored FROM customer")
def merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal copies are skipped, a differing reference copy is ignored."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    regions = read(spark, sf_dir, "region")
    merged, ignored = merge_outputs(
        [
            ("one", {"customer": customers, "region": regions}),
            ("two", {"customer": customers.orderBy("c_name"), "region": regions.where("r_regionkey > 0")}),
        ],
        reference=["region"],
    )
    return merged["customer"].withColumn("ignored", F.lit(len(ignored)).cast("bigint"))


# --- checks ------------------------------------------------------------------


@query(
    "q_check_repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2."""
    return repeated_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q_check_null_keys",
    "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id FROM events WHERE event_id % 10 = 0",
)
def check_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1."""
    rows = read(spark, sf_dir, "events").select(
        "event_id", F.when(C("event_id") % 10 != 0, C("user_id")).alias("user_id")
    )
    return null_keys(rows, ["event_id", "user_id"])


@query(
    "q_check_columns",
    "SELECT * FROM (SELECT 'source' AS column_name, 'too long' AS problem, count(*) FILTER (WHERE length(source) > 4) AS n FROM documents "
    "UNION ALL SELECT 'n_chars', 'out of range', count(*) FILTER (WHERE n_chars > 32767) FROM documents "
    "UNION ALL SELECT 'lang', 'null', count(*) FILTER (WHERE doc_id % 6 = 0) FROM documents "
    "UNION ALL SELECT 'text', 'too long', count(*) FILTER (WHERE length(text) > 500) FROM documents) WHERE n > 0",
)
def check_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths, ranges and nulls in one pass."""
    rows = read(spark, sf_dir, "documents").withColumn("lang", F.when(C("doc_id") % 6 != 0, F.lit("en")))
    declared = output_columns(
        "doc_id bigint not null, text varchar(500), lang char(2) not null, source varchar(4), n_chars smallint"
    )
    return column_problems(rows, declared)


@query(
    "q_quarantine",
    "SELECT event_id, CASE event_id % 50 WHEN 0 THEN substr(props, 1, length(props) - 1) ELSE '' END AS value FROM events "
    "WHERE event_id % 50 IN (0, 1)",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: lines cut short and empty lines are set aside, the others are not."""
    value = F.expr("CASE event_id % 50 WHEN 0 THEN substr(props, 1, length(props) - 1) WHEN 1 THEN '' ELSE props END")
    return malformed(read(spark, sf_dir, "events").select("event_id", value.alias("value")), "works")


# Works of which one field in turn has another type than the rest of the snapshot gives it.
_TWO_AUTHORS = """'[{"author":{"id":"A1"},"countries":["NL"]},{"author":{"id":"A2"},"countries":["NL"]}]'"""
_ODD = {
    "biblio": """CASE event_id % 14 WHEN 1 THEN '[]' WHEN 13 THEN 'false' ELSE '{"volume":"' || event_id % 100 || '"}' END""",
    "ids": """CASE event_id % 14 WHEN 2 THEN '""' ELSE '{"pmid":' || event_id || '}' END""",
    "authorships": """CASE event_id % 14 WHEN 3 THEN '{}' WHEN 11 THEN '[{"author":[],"countries":""},{"author":0,"countries":{}}]' """
    f"ELSE {_TWO_AUTHORS} END",
    "open_access": """CASE event_id % 14 WHEN 4 THEN 'false' ELSE '{"is_oa":' || CASE WHEN event_id % 3 = 0 THEN 'true' ELSE 'false' END || '}' END""",
    "abstract_inverted_index": """CASE event_id % 14 WHEN 5 THEN '[]' WHEN 6 THEN '{"z":[0.0],"b":[1.0],"a":[1.0]}' ELSE '{"z":[0],"b":[1],"a":[1]}' END""",
    "referenced_works": """CASE event_id % 14 WHEN 7 THEN '""' ELSE '["W1","W2"]' END""",
    "apc_list": """CASE event_id % 14 WHEN 8 THEN '0' ELSE '{"value":' || event_id % 1000 || '}' END""",
    "title": """CASE event_id % 14 WHEN 9 THEN 'false' WHEN 10 THEN '[]' ELSE '"Title ' || event_id || '"' END""",
    "display_name": """'"Shown ' || event_id || '"'""",
    "type": """CASE event_id % 14 WHEN 12 THEN '{}' ELSE '"' || event_type || '"' END""",
}


@query(
    "q_odd_shapes",
    "SELECT event_id, CASE WHEN event_id % 14 NOT IN (1, 13) THEN CAST(event_id % 100 AS VARCHAR) END AS volume, "
    "CASE WHEN event_id % 14 <> 2 THEN event_id END AS pmid, CASE WHEN event_id % 14 <> 4 THEN CAST(event_id % 3 = 0 AS BIGINT) END AS is_oa, "
    f"{BIG('CASE WHEN event_id % 14 = 3 THEN 0 ELSE 2 END')} AS n_authors, "
    f"{BIG('CASE WHEN event_id % 14 IN (3, 11) THEN 0 ELSE 2 END')} AS n_known, {BIG('CASE WHEN event_id % 14 IN (3, 11) THEN 0 ELSE 2 END')} AS n_countries, "
    "CASE WHEN event_id % 14 <> 5 THEN 'z a' END AS abstract, "
    f"{BIG('CASE WHEN event_id % 14 = 7 THEN 0 ELSE 2 END')} AS n_refs, CASE WHEN event_id % 14 <> 8 THEN event_id % 1000 END AS price, "
    "CASE WHEN event_id % 14 IN (9, 10) THEN 'Shown ' ELSE 'Title ' END || event_id AS title, "
    "CASE WHEN event_id % 14 = 12 THEN 'other' ELSE replace(event_type, '_', '-') END AS type FROM events",
)
def odd_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: a field of another type is absent and costs its document nothing else."""
    pairs = " || ',' || ".join(f"""'"{name}":' || {value}""" for name, value in _ODD.items())
    value = F.expr(f"""'{{"id":"W' || event_id || '",' || {pairs} || '}}'""")
    rows = documents(read(spark, sf_dir, "events").select("event_id", value.alias("value")), "works")

    def count(array: Column) -> Column:
        return F.coalesce(F.size(array).cast("bigint"), F.lit(0).cast("bigint"))

    return rows.select(
        "event_id", C("biblio.volume").alias("volume"), X.longest_number(C("ids.pmid")).alias("pmid"),
        X.flag_of_json(C("open_access.is_oa")).cast("bigint").alias("is_oa"), count(C("authorships")).alias("n_authors"),
        count(A.not_null(C("authorships.author.id"))).alias("n_known"), count(F.flatten(A.not_null(C("authorships.countries")))).alias("n_countries"),
        A.text_from_positions(C("abstract_inverted_index")).alias("abstract"), count(C("referenced_works")).alias("n_refs"),
        X.whole_of_json(C("apc_list.value")).alias("price"), works.title().alias("title"), works.work_type().alias("type"),
    )


@query("q_conform", "SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_rank, CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice, o_orderstatus FROM orders")
def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: declared order, missing columns null, unknown ones gone."""
    return conform(
        read(spark, sf_dir, "orders"),
        output_columns("o_orderkey bigint not null, o_rank smallint, o_totalprice int, o_orderstatus char(1)"),
    )


# --- files -------------------------------------------------------------------

_DAY = "strftime(ts, '%Y-%m-%d')"


def event_snapshot(spark: SparkSession, sf_dir: str) -> str:
    """Events as gzip JSON lines, partitioned by day, in event order within a day."""
    root = fresh_folder(spark)
    events = read(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.concat(F.lit("W"), "event_id").alias("id"), C("event_type").alias("type"))).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("updated_date"),
        "event_id",
    )
    ordered = events.repartitionByRange("updated_date", "event_id").sortWithinPartitions("updated_date", "event_id")
    ordered.drop("event_id").write.option("compression", "gzip").partitionBy("updated_date").text(f"{root}/works")
    return root


def event_rows(lines: DataFrame) -> DataFrame:
    docs = documents(lines, "works", ("type",))
    return docs.select(C("_id").alias("event_id"), C("_partition").alias("day"), C("type").alias("event_type"))


@query("q_scan", f"SELECT event_id, {_DAY} AS day, event_type FROM events")
def scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1."""
    return event_rows(scan(spark, event_snapshot(spark, sf_dir), "works"))


@query(
    "q_scan_order",
    f"SELECT event_id, {BIG('row_number() OVER (ORDER BY ' + _DAY + ', event_id)')} AS place FROM events",
)
def scan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan order is partition, file, line; its ranks are compared."""
    docs = documents(scan(spark, event_snapshot(spark, sf_dir), "works"), "works", ())
    # The order as a text that sorts like the number, to be ranked without one task.
    order = F.lpad(C("_ord").cast("string"), 20, "0")
    ranked, _ = dense_ids(docs.select(F.lit("order").alias("catalogue"), order.alias("value")))
    placed = docs.select(C("_id").alias("event_id"), order.alias("value")).join(ranked, "value")
    return placed.select("event_id", C("id").alias("place"))


@query(
    "q_scan_partitions",
    f"SELECT event_id, {_DAY} AS day, event_type FROM events WHERE {_DAY} IN "
    f"(SELECT DISTINCT d FROM (SELECT {_DAY} AS d, dense_rank() OVER (ORDER BY {_DAY}) AS r FROM events) WHERE r % 2 = 0)",
)
def scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second day, asked for twice; days that do not exist are skipped."""
    root = event_snapshot(spark, sf_dir)
    days = [r["d"] for r in read(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct().orderBy("d").collect()]
    return event_rows(scan(spark, root, "works", updated_dates=[*days[1::2], *days[1::2], "1900-01-01"]))


@query("q_scan_first_records", f"SELECT event_id, {_DAY} AS day, event_type FROM events ORDER BY {_DAY}, event_id LIMIT 777")
def scan_first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first documents in scan order; here the cap is the feature."""
    return event_rows(scan(spark, event_snapshot(spark, sf_dir), "works", max_records=777))


@query(
    "q_scan_first_files",
    f"SELECT event_id, {_DAY} AS day, event_type FROM events WHERE {_DAY} IN (SELECT DISTINCT {_DAY} AS d FROM events ORDER BY d LIMIT 5)",
)
def scan_first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the first files in scan order; one file a day here, so the first days."""
    events = read(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.concat(F.lit("W"), "event_id").alias("id"), C("event_type").alias("type"))).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("updated_date"),
    )
    root = fresh_folder(spark)
    events.repartition("updated_date").write.option("compression", "gzip").partitionBy("updated_date").text(f"{root}/works")
    return event_rows(scan(spark, root, "works", max_files=5))


def two_entities(spark: SparkSession, sf_dir: str) -> str:
    """Events as works and customers as authors, gzip JSON lines."""
    root = fresh_folder(spark)
    for entity, table, key in (("works", "events", "event_id"), ("authors", "customer", "c_custkey")):
        lines = read(spark, sf_dir, table).select(F.to_json(F.struct(F.concat(F.lit("X"), key).alias("id"))).alias("value"), F.lit("2024-01-01").alias("updated_date"))
        lines.write.option("compression", "gzip").partitionBy("updated_date").text(f"{root}/{entity}")
    return root


@query(
    "q_missing_entity",
    f"SELECT 'authors' AS entity, {BIG('count(*)')} AS n FROM customer UNION ALL SELECT 'topics', 0 UNION ALL SELECT 'works', {BIG('count(*)')} FROM events",
)
def missing_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity the snapshot lacks has no lines, and the others are read."""
    root = two_entities(spark, sf_dir)
    counts = [scan(spark, root, e).agg(F.lit(e).alias("entity"), F.count(F.lit(1)).alias("n")) for e in ("authors", "topics", "works")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "q_chosen_entities",
    f"SELECT {BIG(0)} AS place, 'works' AS entity, count(*) AS read FROM events UNION ALL SELECT 1, 'authors', count(*) FROM customer",
)
def chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities asked for more than once are read once, in the order asked for."""
    root = two_entities(spark, sf_dir)
    options = Options(root, f"{root}/out", f"{root}/ids", f"{root}/staged")
    rows = [(i, e, stage(spark, options, e)[1].read) for i, e in enumerate(chosen_entities(["works", "authors", "works"]))]
    return spark.createDataFrame(rows, "place bigint, entity string, read bigint")


@query(
    "q_enum_normaliser",
    "SELECT c_custkey, id FROM customer JOIN "
    f"{numbers('SELECT lower(substr(trim(c_mktsegment), 1, 1 + c_custkey % 3)) AS v FROM customer')} n ON n.v = lower(substr(trim(c_mktsegment), 1, 1 + c_custkey % 3))",
)
def enum_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An enumeration with a rule of its own for its values, numbered and looked up by it."""
    config = CatalogueConfig("segment", "varchar(3)", normalise=lambda c: F.lower(X.strip(c)))
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey", config.cleaned(F.concat(F.lit(" "), F.substring(X.strip(C("c_mktsegment")), F.lit(1), (1 + C("c_custkey") % 3).cast("int")))).alias("value")
    )
    ids, _ = dense_ids(rows.select(F.lit("segment").alias("catalogue"), "value").distinct())
    return rows.join(ids, "value").select("c_custkey", "id")


@query(
    "q_run_report",
    "SELECT 'works' AS entity, count(*) AS read, count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 7 <> 0) AS processed, "
    "count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 7 = 0) AS skipped_merged, count(*) FILTER (WHERE event_id % 11 = 0) AS malformed "
    "FROM events",
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a staged entity reports, with every eleventh line cut short and every
    seventh document merged into another."""
    events = read(spark, sf_dir, "events")
    line = F.to_json(F.struct(F.concat(F.lit("W"), "event_id").alias("id"), C("event_type").alias("type")))
    lines = events.select(
        F.when(C("event_id") % 11 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("updated_date")
    )
    root = fresh_folder(spark)
    lines.write.option("compression", "gzip").partitionBy("updated_date").text(f"{root}/works")
    merged = events.where("event_id % 7 = 0").select(F.concat(F.lit(URL + "W"), "event_id").alias("id"))
    merged.write.option("header", True).csv(f"{root}/merged_ids/works")
    options = Options(root, f"{root}/out", f"{root}/ids", f"{root}/staged", entities=("works",), skip_merged=True)
    return report_frame(spark, {"works": stage(spark, options, "works")[1]})


@query(
    "q_partial_catalogue",
    "SELECT 'works' AS entity, 'work_type' AS catalogue, count(DISTINCT event_type) AS n FROM events WHERE event_type > (SELECT min(event_type) FROM events)",
)
def partial_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue saved from some documents, reused on all of them, says what it lacks."""
    lines = read(spark, sf_dir, "events").select(
        C("event_id").alias("_ord"), C("event_type"), F.to_json(F.struct(F.concat(F.lit("W"), "event_id").alias("id"), C("event_type").alias("type"))).alias("value")
    )
    least = lines.agg(F.min("event_type")).first()[0]
    folder = fresh_folder(spark)
    part = documents(lines.where(C("event_type") == least).drop("event_type"), "works")
    save_catalogue(collect({"works": part}, FEEDS), folder, ["works"])
    return uncatalogued(spark, {"works": documents(lines.drop("event_type"), "works")}, load_catalogue(spark, folder))


_EXPORTED = (
    f"SELECT doc_id || '' AS doc_id, coalesce({collapsed('text')}, '') AS text, CASE WHEN doc_id % 2 = 0 THEN '1' ELSE '0' END AS even, "
    "CASE WHEN doc_id % 3 = 0 THEN '' ELSE n_chars || '.5' END AS size, CASE doc_id % 4 WHEN 0 THEN '' ELSE '1.5e-0' || (4 + doc_id % 4) END AS tiny FROM documents"
)


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "doc_id % 2 = 0 AS even", "CASE WHEN doc_id % 3 <> 0 THEN n_chars + 0.5D END AS size",
        "CASE doc_id % 4 WHEN 1 THEN 1.5e-5D WHEN 2 THEN 1.5e-6D WHEN 3 THEN 1.5e-7D END AS tiny",
    )


@query("q_format_cells", _EXPORTED)
def format_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3."""
    return formatted(export_rows(spark, sf_dir))


def _reread(spark: SparkSession, sf_dir: str, delimiter: str, encoding: str) -> DataFrame:
    path = fresh_folder(spark)
    write_delimited(export_rows(spark, sf_dir), path, delimiter, encoding)
    back = spark.read.option("header", True).option("sep", delimiter).option("escape", '"').option("encoding", encoding)
    return back.csv(path).na.fill("")


@query("q_delimited_files", _EXPORTED)
def delimited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: written and read back, tab-separated."""
    return _reread(spark, sf_dir, "\t", "UTF-8")


@query("q_delimited_files_comma", _EXPORTED)
def delimited_files_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 with a delimiter that occurs in the texts."""
    return _reread(spark, sf_dir, ",", "UTF-8")

