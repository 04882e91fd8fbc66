"""Tables of the works entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import ARXIV, CROSSREF, DATACITE, DOAJ, PUBMED, SHORT_ID
from ..functions import text as X
from ..functions.arrays import let, not_null, numbered, text_from_positions, where_present, with_places
from ..operators.catalogue import Catalogue, Feed
from ..operators.first_wins import first_wins, place
from .tables import table

C = F.col
WORK_ID = "work_id bigint not null"


def _id() -> Column:
    return C("_id").alias("work_id")


def _elements(array: Column) -> Column:
    return F.coalesce(array, F.array().cast("array<string>"))


# --- values shared by tables and catalogues ---------------------------------


def work_type() -> Column:
    return F.translate(F.coalesce(X.filled(C("type")), F.lit("other")), "_", "-")


def crossref_type() -> Column:
    return F.coalesce(X.filled(C("type_crossref")), work_type())


def author_name(a: Column) -> Column:
    return X.first_filled(a["raw_author_name"], a["author"]["display_name"])


def affiliation_texts(a: Column) -> Column:
    return X.affiliation_texts(a["raw_affiliation_strings"], a["raw_affiliation_string"])


def known_affiliations(authorships: Column) -> Column:
    """Distinct affiliation texts of a work; the place in this list is the number."""
    return F.array_distinct(F.flatten(F.transform(authorships, affiliation_texts)))


def keyword_text(k: Column) -> Column:
    return X.first_filled(k["keyword"], k["display_name"])


def title() -> Column:
    return X.collapse_spaces(X.first_filled(C("title"), C("display_name")))


def work_doi() -> Column:
    return X.doi(X.first_filled(C("ids.doi"), C("doi")))


def in_location(location: Column, path: str) -> Column:
    """A text of a location, null where it is no object."""
    return F.try_variant_get(location, f"$.{path}", "string")


def compared(location: Column) -> Column:
    """Equal locations have equal text, whatever the order of their keys; one that is
    empty or absent equals an empty object."""
    text = F.coalesce(F.to_json(location), F.lit("null"))
    return let(text, lambda t: F.when(t.isin("null", "false", "0", '""', "[]"), "{}").otherwise(t))


def data_sources() -> Column:
    """Names in the order tested."""
    agency = F.lower(X.filled(C("doi_registration_agency")))

    def in_doaj(location: Column) -> Column:
        # False, zero, null and absent say no.
        listed = in_location(location, "source.is_in_doaj")
        return F.coalesce(~listed.isin("false", "0", ""), F.lit(False))

    def name_if(test: Column, name: str) -> Column:
        return F.when(F.coalesce(test, F.lit(False)), F.lit(name))

    return not_null(
        F.array(
            name_if(X.filled(C("ids.arxiv")).isNotNull(), ARXIV),
            name_if(X.first_filled(C("ids.pmid"), C("ids.pmcid")).isNotNull(), PUBMED),
            F.when(agency == DATACITE, F.lit(DATACITE)).when(agency.isNotNull(), F.lit(CROSSREF)),
            name_if(in_doaj(C("best_oa_location")) | in_doaj(C("primary_location")), DOAJ),
        )
    )


FEEDS = (
    Feed("work_type", "works", ("type", "type_crossref"), lambda: F.array(work_type(), crossref_type())),
    Feed("doi_registration_agency", "works", ("doi_registration_agency",),
         lambda: F.array(C("doi_registration_agency"))),
    Feed("oa_status", "works", ("open_access",), lambda: F.array(C("open_access.oa_status"))),
    Feed("apc_provenance", "works", ("apc_list", "apc_paid"),
         lambda: F.array(C("apc_list.provenance"), C("apc_paid.provenance"))),
    Feed("fulltext_origin", "works", ("fulltext_origin",), lambda: F.array(C("fulltext_origin"))),
    Feed("data_source", "works", ("ids", "doi_registration_agency", "best_oa_location", "primary_location"),
         data_sources),
    Feed("version", "works", ("locations",),
         lambda: _elements(F.transform(C("locations"), lambda l: in_location(l, "version")))),
    Feed("license", "works", ("locations",),
         lambda: _elements(F.transform(C("locations"), lambda l: in_location(l, "license")))),
    Feed("author_position", "works", ("authorships",),
         lambda: _elements(C("authorships.author_position"))),
    Feed("keyword", "works", ("keywords",),
         lambda: _elements(F.transform(C("keywords"), keyword_text))),
    Feed("raw_affiliation_string", "works", ("authorships",),
         lambda: _elements(known_affiliations(C("authorships")))),
    Feed("raw_author_name", "works", ("authorships",),
         lambda: _elements(F.transform(C("authorships"), lambda a: X.spaced_once(author_name(a))))),
)


# --- the work itself ---------------------------------------------------------


@table(
    "work", "works",
    f"{WORK_ID}, work_type_id smallint, crossref_work_type_id smallint, source_id bigint, pub_date date, "
    "pub_year smallint, volume varchar(200), issue varchar(80), page_first varchar(200), page_last varchar(300), "
    f"doi_registration_agency_id smallint, doi varchar(350), {SHORT_ID} varchar(32), mag_id bigint, pmid bigint, "
    "pmcid bigint, arxiv_id varchar(80), language_iso2_code char(2), is_paratext boolean, is_retracted boolean, "
    "is_oa boolean, any_repository_has_fulltext boolean, oa_status_id smallint, oa_url varchar(4000), "
    "apc_list_currency char(3), apc_list_price int, apc_list_price_usd int, apc_list_apc_provenance_id smallint, "
    "apc_paid_currency char(3), apc_paid_price int, apc_paid_price_usd int, apc_paid_apc_provenance_id smallint, "
    "fulltext_origin_id smallint, n_refs int, n_cits int, updated_date date, created_date date",
    key="work_id",
    reads="type type_crossref doi doi_registration_agency publication_date publication_year language is_paratext "
    "is_retracted fulltext_origin referenced_works_count cited_by_count updated_date created_date ids biblio "
    "open_access apc_list apc_paid primary_location",
    catalogues=("work_type", "doi_registration_agency", "oa_status", "apc_provenance", "fulltext_origin"),
)
def work(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = docs.select(
        _id(),
        X.id_number(in_location(C("primary_location"), "source.id")).alias("source_id"),
        X.day(C("publication_date")).alias("pub_date"),
        X.whole_of_json(C("publication_year")).alias("pub_year"),
        C("biblio.volume").alias("volume"),
        C("biblio.issue").alias("issue"),
        C("biblio.first_page").alias("page_first"),
        C("biblio.last_page").alias("page_last"),
        work_doi().alias("doi"),
        C("_short").alias(SHORT_ID),
        X.whole_of_json(C("ids.mag")).alias("mag_id"),
        X.longest_number(C("ids.pmid")).alias("pmid"),
        X.longest_number(C("ids.pmcid")).alias("pmcid"),
        X.short_id(C("ids.arxiv")).alias("arxiv_id"),
        X.language_code(C("language")).alias("language_iso2_code"),
        X.flag_of_json(C("is_paratext")).alias("is_paratext"),
        X.flag_of_json(C("is_retracted")).alias("is_retracted"),
        X.flag_of_json(C("open_access.is_oa")).alias("is_oa"),
        X.flag_of_json(C("open_access.any_repository_has_fulltext")).alias("any_repository_has_fulltext"),
        C("open_access.oa_url").alias("oa_url"),
        C("apc_list.currency").alias("apc_list_currency"),
        X.whole_of_json(C("apc_list.value")).alias("apc_list_price"),
        X.whole_of_json(C("apc_list.value_usd")).alias("apc_list_price_usd"),
        C("apc_paid.currency").alias("apc_paid_currency"),
        X.whole_of_json(C("apc_paid.value")).alias("apc_paid_price"),
        X.whole_of_json(C("apc_paid.value_usd")).alias("apc_paid_price_usd"),
        X.whole_of_json(C("referenced_works_count")).alias("n_refs"),
        X.whole_of_json(C("cited_by_count")).alias("n_cits"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
        work_type().alias("_type"),
        crossref_type().alias("_crossref"),
        C("doi_registration_agency").alias("_agency"),
        C("open_access.oa_status").alias("_oa_status"),
        C("apc_list.provenance").alias("_listed"),
        C("apc_paid.provenance").alias("_paid"),
        C("fulltext_origin").alias("_origin"),
    )
    for name, value, out in (
        ("work_type", "_type", "work_type_id"),
        ("work_type", "_crossref", "crossref_work_type_id"),
        ("doi_registration_agency", "_agency", "doi_registration_agency_id"),
        ("oa_status", "_oa_status", "oa_status_id"),
        ("apc_provenance", "_listed", "apc_list_apc_provenance_id"),
        ("apc_provenance", "_paid", "apc_paid_apc_provenance_id"),
        ("fulltext_origin", "_origin", "fulltext_origin_id"),
    ):
        rows = catalogue.lookup(rows, name, C(value), out)
    return rows


@table("work_title", "works", f"{WORK_ID}, title string", key="work_id", reads="title display_name")
def work_title(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return where_present(docs, [_id()], title(), "title")


@table("work_abstract", "works", f"{WORK_ID}, abstract string", key="work_id", reads="abstract_inverted_index")
def work_abstract(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    text = X.collapse_spaces(text_from_positions(C("abstract_inverted_index")))
    return where_present(docs, [_id()], text, "abstract")


# --- flat children, numbered by their place (W1) -----------------------------


def _scored(docs: DataFrame, array: str, seq: str, target: str) -> DataFrame:
    rows = numbered(docs, [_id()], C(array), seq)
    return rows.select(
        "work_id", seq, X.id_number(C("item.id")).alias(target), X.decimal_number(C("item.score")).alias("score")
    )


@table(
    "work_concept", "works", f"{WORK_ID}, concept_seq smallint not null, concept_id bigint, score double",
    key="work_id concept_seq", reads="concepts",
)
def work_concept(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return _scored(docs, "concepts", "concept_seq", "concept_id").where(C("concept_id").isNotNull())


@table(
    "work_topic", "works",
    f"{WORK_ID}, topic_seq smallint not null, topic_id smallint, score double, is_primary_topic boolean",
    key="work_id topic_seq", reads="topics",
)
def work_topic(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return _scored(docs, "topics", "topic_seq", "topic_id").where(C("topic_id").isNotNull())


@table(
    "work_sustainable_development_goal", "works",
    f"{WORK_ID}, sustainable_development_goal_seq smallint not null, sustainable_development_goal_id smallint, "
    "score double",
    key="work_id sustainable_development_goal_seq", reads="sustainable_development_goals",
)
def work_sustainable_development_goal(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    seq = "sustainable_development_goal_seq"
    return numbered(docs, [_id()], C("sustainable_development_goals"), seq).select(
        "work_id", seq,
        X.segment_number(C("item.id")).alias("sustainable_development_goal_id"),
        X.decimal_number(C("item.score")).alias("score"),
    )


@table(
    "sustainable_development_goal", "works",
    "sustainable_development_goal_id smallint not null, sustainable_development_goal varchar(40), "
    "taxonomy_url varchar(30)",
    key="sustainable_development_goal_id", reads="sustainable_development_goals", shared=True,
)
def sustainable_development_goal(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, ["_ord"], C("sustainable_development_goals"), "_seq").select(
        X.segment_number(C("item.id")).alias("sustainable_development_goal_id"),
        C("item.display_name").alias("sustainable_development_goal"),
        C("item.id").alias("taxonomy_url"),
        place(C("_ord"), C("_seq")).alias("_place"),
    )
    return first_wins(
        rows.where(C("sustainable_development_goal_id").isNotNull()),
        ["sustainable_development_goal_id"], ["sustainable_development_goal", "taxonomy_url"], "_place",
    )


@table(
    "work_keyword", "works", f"{WORK_ID}, keyword_seq smallint not null, keyword_id int, score double",
    key="work_id keyword_seq", reads="keywords", catalogues=("keyword",),
)
def work_keyword(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], C("keywords"), "keyword_seq").select(
        "work_id", "keyword_seq",
        keyword_text(C("item")).alias("_text"),
        X.decimal_number(C("item.score")).alias("score"),
    )
    return catalogue.lookup(rows.where(C("_text").isNotNull()), "keyword", C("_text"), "keyword_id")


def _mesh_names(docs: DataFrame, kind: str) -> DataFrame:
    key, name = f"mesh_{kind}_ui", f"mesh_{kind}"
    rows = numbered(docs, ["_ord"], C("mesh"), "_seq").select(
        X.filled(C(f"item.{kind}_ui")).alias(key),
        X.filled(C(f"item.{kind}_name")).alias(name),
        place(C("_ord"), C("_seq")).alias("_place"),
    )
    return first_wins(rows.where(C(key).isNotNull() & C(name).isNotNull()), [key], [name], "_place")


for _kind, _width in (("descriptor", 120), ("qualifier", 40)):
    table(
        f"mesh_{_kind}", "works", f"mesh_{_kind}_ui varchar(10) not null, mesh_{_kind} varchar({_width})",
        key=f"mesh_{_kind}_ui", reads="mesh", shared=True,
    )(lambda docs, _catalogue, kind=_kind: _mesh_names(docs, kind))


@table(
    "work_mesh", "works",
    f"{WORK_ID}, mesh_seq smallint not null, mesh_descriptor_ui varchar(10), mesh_qualifier_ui varchar(10), "
    "is_major_topic boolean",
    key="work_id mesh_seq", reads="mesh",
)
def work_mesh(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return numbered(docs, [_id()], C("mesh"), "mesh_seq").select(
        "work_id", "mesh_seq",
        C("item.descriptor_ui").alias("mesh_descriptor_ui"),
        C("item.qualifier_ui").alias("mesh_qualifier_ui"),
        X.flag_of_json(C("item.is_major_topic")).alias("is_major_topic"),
    )


@table(
    "work_location", "works",
    f"{WORK_ID}, location_seq smallint not null, is_primary_location boolean, is_best_oa_location boolean, "
    "source_id bigint, landing_page_url varchar(2000), pdf_url varchar(4000), version_id smallint, "
    "license_id smallint, is_oa boolean, is_accepted boolean, is_published boolean",
    key="work_id location_seq", reads="locations primary_location best_oa_location",
    catalogues=("version", "license"),
)
def work_location(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    keep = [_id(), compared(C("primary_location")).alias("_primary"), compared(C("best_oa_location")).alias("_best")]
    l = C("item")
    rows = numbered(docs, keep, C("locations"), "location_seq").select(
        "work_id", "location_seq", "_primary", "_best", F.to_json(l).alias("_text"),
        in_location(l, "source.id").alias("_source"),
        in_location(l, "landing_page_url").alias("landing_page_url"),
        in_location(l, "pdf_url").alias("pdf_url"),
        X.flag_of_json(F.try_variant_get(l, "$.is_oa", "variant")).alias("is_oa"),
        in_location(l, "version").alias("_version"),
        in_location(l, "license").alias("_license"),
    )
    version = F.lower(F.coalesce(C("_version"), F.lit("")))
    rows = rows.select(
        "work_id", "location_seq", "landing_page_url", "pdf_url", "is_oa", "_version", "_license",
        (C("_text") == C("_primary")).alias("is_primary_location"),
        (C("_text") == C("_best")).alias("is_best_oa_location"),
        X.id_number(C("_source")).alias("source_id"),
        (version == "acceptedversion").alias("is_accepted"),
        (version == "publishedversion").alias("is_published"),
    )
    rows = catalogue.lookup(rows, "version", C("_version"), "version_id")
    return catalogue.lookup(rows, "license", C("_license"), "license_id")


# --- authorships -------------------------------------------------------------


@table(
    "work_affiliation", "works", f"{WORK_ID}, affiliation_seq smallint not null, raw_affiliation_string_id bigint",
    key="work_id affiliation_seq", reads="authorships", catalogues=("raw_affiliation_string",),
)
def work_affiliation(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], known_affiliations(C("authorships")), "affiliation_seq", "_text")
    return catalogue.lookup(rows, "raw_affiliation_string", C("_text"), "raw_affiliation_string_id")


@table(
    "work_author", "works",
    f"{WORK_ID}, author_seq smallint not null, author_id bigint, author_position_id smallint, "
    "is_corresponding_author boolean, raw_author_name_id bigint",
    key="work_id author_seq", reads="authorships", catalogues=("author_position", "raw_author_name"),
)
def work_author(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], C("authorships"), "author_seq").select(
        "work_id", "author_seq",
        X.id_number(C("item.author.id")).alias("author_id"),
        X.flag_of_json(C("item.is_corresponding")).alias("is_corresponding_author"),
        C("item.author_position").alias("_position"),
        X.collapse_spaces(author_name(C("item"))).alias("_name"),
    )
    rows = catalogue.lookup(rows, "author_position", C("_position"), "author_position_id")
    return catalogue.lookup(rows, "raw_author_name", C("_name"), "raw_author_name_id")


@table(
    "work_author_affiliation", "works",
    f"{WORK_ID}, author_seq smallint not null, affiliation_seq smallint not null",
    key="work_id author_seq affiliation_seq", reads="authorships", repeats=True,
)
def work_author_affiliation(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    """Repeated texts of an authorship give repeated rows (C2 reports them)."""
    places = let(
        F.transform(C("authorships"), affiliation_texts),
        lambda texts: let(
            F.array_distinct(F.flatten(texts)),
            lambda known: with_places(
                known, lambda place: F.transform(texts, lambda own: F.transform(own, place))
            ),
        ),
    )
    rows = numbered(docs, [_id()], places, "author_seq")
    return rows.select("work_id", "author_seq", F.explode("item").alias("affiliation_seq"))


@table(
    "work_author_country", "works",
    f"{WORK_ID}, author_seq smallint not null, country_seq smallint not null, country_iso_alpha2_code char(3)",
    key="work_id author_seq country_seq", reads="authorships",
)
def work_author_country(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    authors = numbered(docs, [_id()], C("authorships.countries"), "author_seq", "_codes")
    rows = numbered(authors, ["work_id", "author_seq"], C("_codes"), "country_seq", "country_iso_alpha2_code")
    return rows.where(X.filled(C("country_iso_alpha2_code")).isNotNull())


def affiliation_institutions(authorships: Column) -> Column:
    """Links ``(affiliation_seq, institution_seq, institution_id)`` of one work.

    A fold over the authorships carries the links found so far.  An authorship
    adds the new ones among its explicit links; only when it has no new one does
    it fall back to its institutions, paired with its texts by place (the last
    text serving the rest) or, without texts, with their own names.  Links are
    held in pieces by affiliation: a step searches the pieces its links belong to,
    and all links of an affiliation stand in one piece, in order.  They are held as
    one number each, which Spark passes on without copying it, unlike texts and structs.
    """
    empty, no_links, held_type = F.array().cast("array<string>"), F.array().cast("array<struct<affiliation: bigint, held: decimal(38,0)>>"), "decimal(38,0)"
    pieces = F.when(F.size(authorships) <= 64, F.lit(1)).otherwise(F.ceil(F.sqrt(F.size(authorships))).cast("int"))

    def piece(link: Column) -> Column:
        return F.pmod(link["affiliation"], pieces).cast("int")

    def link(place: Callable[[Column], Column], label: Column, institution: Column) -> Column:
        number = X.id_number(institution).cast("decimal(19,0)")
        both = let(place(label), lambda n: F.struct(n.alias("affiliation"), (n.cast("decimal(10,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + number).cast(held_type).alias("held")))
        return let(both, lambda b: F.when((b["affiliation"] > 0) & b["held"].isNotNull(), b))

    def explicit(place: Callable[[Column], Column], a: Column) -> Column:
        return F.flatten(
            F.transform(
                a["affiliations"],
                lambda f: let(
                    X.spaced_once(f["raw_affiliation_string"]),
                    lambda label: F.transform(
                        F.coalesce(f["institution_ids"], empty), lambda i: link(place, label, i)
                    ),
                ),
            )
        )

    def implied(place: Callable[[Column], Column], a: Column, texts: Column) -> Column:
        return F.transform(
            a["institutions"],
            lambda s, i: link(
                place,
                F.when(F.size(texts) == 0, X.filled(s["display_name"])).otherwise(
                    F.get(texts, F.least(i, F.size(texts) - 1))
                ),
                s["id"],
            ),
        )

    def fold(texts: Column, place: Callable[[Column], Column]) -> Column:
        pairs = F.zip_with(authorships, texts, lambda a, own: F.struct(a.alias("a"), own.alias("texts")))

        def step(found: Column, pair: Column) -> Column:
            def new(links: Column) -> Column:
                distinct = F.array_distinct(not_null(F.coalesce(links, no_links)))
                return F.filter(distinct, lambda l: ~F.array_contains(F.get(found, piece(l)), l["held"]))

            def added(fresh: Column) -> Column:
                return F.when(F.size(fresh) == 0, found).otherwise(
                    F.transform(
                        found,
                        lambda held, i: F.when(
                            F.exists(fresh, lambda l: piece(l) == i),
                            F.concat(held, F.transform(F.filter(fresh, lambda l: piece(l) == i), lambda l: l["held"])),
                        ).otherwise(held),
                    )
                )

            # The implied links are worked out only where they are needed.
            return let(
                let(
                    new(explicit(place, pair["a"])),
                    lambda fresh: F.when(F.size(fresh) > 0, fresh).otherwise(new(implied(place, pair["a"], pair["texts"]))),
                ),
                added,
            )

        return F.aggregate(pairs, F.transform(F.sequence(F.lit(1), pieces), lambda _: F.array().cast(f"array<{held_type}>")), step)

    def numbered_links(links: Column) -> Column:
        """Sorted by affiliation, the number of a link is its distance from the
        affiliation's first link."""
        placed = F.transform(
            links,
            lambda l, i: let(
                l.cast("string"),
                lambda t: F.struct(
                    F.substring(t, F.lit(1), F.length(t) - 19).cast("bigint").alias("n"), i.alias("i"), F.right(t, F.lit(19)).cast("bigint").alias("institution"),
                ),
            ),
        )
        return let(
            F.sort_array(placed),
            lambda s: let(
                F.transform(s, lambda e: e["n"]),
                lambda ns: F.transform(
                    s,
                    lambda e, i: F.struct(
                        e["n"].alias("affiliation_seq"),
                        (i - F.array_position(ns, e["n"]) + 2).alias("institution_seq"),
                        e["institution"].alias("institution_id"),
                    ),
                ),
            ),
        )

    found = let(
        F.transform(authorships, affiliation_texts),
        lambda texts: let(F.array_distinct(F.flatten(texts)), lambda known: with_places(known, lambda place: fold(texts, place))),
    )
    return F.flatten(F.transform(found, numbered_links))


@table(
    "work_affiliation_institution", "works",
    f"{WORK_ID}, affiliation_seq smallint not null, institution_seq smallint not null, institution_id bigint",
    key="work_id affiliation_seq institution_seq", reads="authorships",
)
def work_affiliation_institution(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return docs.select(_id(), F.inline(affiliation_institutions(C("authorships"))))


# --- the rest ----------------------------------------------------------------


@table(
    "work_data_source", "works", f"{WORK_ID}, data_source_seq smallint not null, data_source_id int",
    key="work_id data_source_seq", reads="ids doi_registration_agency best_oa_location primary_location",
    catalogues=("data_source",),
)
def work_data_source(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], data_sources(), "data_source_seq", "_name")
    return catalogue.lookup(rows, "data_source", C("_name"), "data_source_id")


@table(
    "work_grant", "works", f"{WORK_ID}, grant_seq smallint not null, award_id varchar(1000), funder_id bigint",
    key="work_id grant_seq", reads="grants",
)
def work_grant(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return numbered(docs, [_id()], C("grants"), "grant_seq").select(
        "work_id", "grant_seq", C("item.award_id").alias("award_id"), X.id_number(C("item.funder")).alias("funder_id")
    )


@table(
    "work_reference", "works", f"{WORK_ID}, reference_seq int not null, cited_work_id bigint",
    key="work_id reference_seq", reads="referenced_works",
)
def work_reference(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], C("referenced_works"), "reference_seq")
    return rows.select("work_id", "reference_seq", X.id_number(C("item")).alias("cited_work_id"))


@table(
    "work_related", "works", f"{WORK_ID}, related_work_seq smallint not null, related_work_id bigint",
    key="work_id related_work_seq", reads="related_works",
)
def work_related(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [_id()], C("related_works"), "related_work_seq")
    return rows.select("work_id", "related_work_seq", X.id_number(C("item")).alias("related_work_id"))
