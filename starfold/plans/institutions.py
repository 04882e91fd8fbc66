"""Tables of the institutions entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import dense_distinct, not_null, numbered
from ..operators.catalogue import Catalogue, Feed
from ..operators.first_wins import first_wins
from .tables import child, table

C = F.col
INSTITUTION_ID = "institution_id bigint not null"


def role_ids(roles: Column, kind: str) -> Column:
    """Id numbers of the roles of one kind."""
    def number(r: Column) -> Column:
        return F.when(X.object_field(r, "role") == kind, X.id_number(X.object_field(r, "id")))

    return not_null(F.transform(roles, number))


def _associated() -> Column:
    def parsed(a: Column) -> Column:
        return F.struct(
            X.id_number(X.object_field(a, "id")).alias("id"),
            X.object_field(a, "relationship").alias("relationship"),
        )

    return F.filter(F.transform(C("associated_institutions"), parsed), lambda a: a["id"].isNotNull())


FEEDS = (
    Feed("institution_type", "institutions", ("type",), lambda: F.array(C("type"))),
    Feed("region", "institutions", ("geo",), lambda: F.array(C("geo.region"))),
    Feed("institution_relationship_type", "institutions", ("associated_institutions",),
         lambda: F.coalesce(_associated()["relationship"], F.array().cast("array<string>"))),
)


@table(
    "institution", "institutions",
    f"{INSTITUTION_ID}, institution varchar(200), institution_type_id smallint, country_iso_alpha2_code char(3), "
    "region_id smallint, geonames_city_id int, latitude double, longitude double, homepage_url string, "
    f"is_super_system boolean, ror_id varchar(9), grid_id varchar(20), {SHORT_ID} varchar(11), mag_id bigint, "
    "wikidata_id varchar(10), wikipedia_url varchar(800), image_url varchar(800), thumbnail_url varchar(1200), "
    "updated_date date, created_date date",
    key="institution_id",
    reads="display_name type country_code geo homepage_url is_super_system ror ids image_url image_thumbnail_url "
    "updated_date created_date",
    catalogues=("institution_type", "region"),
)
def institution(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = docs.select(
        C("_id").alias("institution_id"),
        C("display_name").alias("institution"),
        C("country_code").alias("country_iso_alpha2_code"),
        X.whole_of_json(C("geo.geonames_city_id")).alias("geonames_city_id"),
        X.decimal_number(C("geo.latitude")).alias("latitude"),
        X.decimal_number(C("geo.longitude")).alias("longitude"),
        C("homepage_url"),
        X.flag_of_json(C("is_super_system")).alias("is_super_system"),
        X.last_segment(C("ror")).alias("ror_id"),
        C("ids.grid").alias("grid_id"),
        C("_short").alias(SHORT_ID),
        X.whole_of_json(C("ids.mag")).alias("mag_id"),
        X.last_segment(C("ids.wikidata")).alias("wikidata_id"),
        C("ids.wikipedia").alias("wikipedia_url"),
        C("image_url"),
        C("image_thumbnail_url").alias("thumbnail_url"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
        C("type").alias("_type"),
        C("geo.region").alias("_region"),
    )
    rows = catalogue.lookup(rows, "institution_type", C("_type"), "institution_type_id")
    return catalogue.lookup(rows, "region", C("_region"), "region_id")


@table(
    "city", "institutions", "geonames_city_id int not null, city varchar(100)",
    key="geonames_city_id", reads="geo", shared=True,
)
def city(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    rows = docs.select(
        "_ord",
        X.whole_of_json(C("geo.geonames_city_id")).alias("geonames_city_id"),
        X.filled(C("geo.city")).alias("city"),
    )
    # Number 0 counts as not set.
    return first_wins(
        rows.where((C("geonames_city_id") != 0) & C("city").isNotNull()), ["geonames_city_id"], ["city"], "_ord"
    )


@table(
    "country", "institutions", "country_iso_alpha2_code char(3) not null, country varchar(50)",
    key="country_iso_alpha2_code", reads="country_code geo", shared=True,
)
def country(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    """The first row of a code wins even when it has no name."""
    rows = docs.select(
        "_ord", X.filled(C("country_code")).alias("country_iso_alpha2_code"), C("geo.country").alias("country")
    )
    return first_wins(
        rows.where(C("country_iso_alpha2_code").isNotNull()), ["country_iso_alpha2_code"], ["country"], "_ord"
    )


child(
    "institution_acronym", "institutions", "institution_id", "acronym_seq", "acronym varchar(70)",
    "display_name_acronyms", lambda: dense_distinct(C("display_name_acronyms")),
)
child(
    "institution_alternative_name", "institutions", "institution_id", "alternative_name_seq",
    "alternative_name varchar(250)", "display_name_alternatives",
    lambda: dense_distinct(C("display_name_alternatives")),
)


def international(name: str, entity: str, owner: str, column: str, width: int, source: str) -> None:
    """O2: a map of language to text; blank texts go.  The key is the language."""
    @table(
        name, entity, f"{owner} bigint not null, language_code varchar(16) not null, {column} varchar({width})",
        key=f"{owner} language_code", reads="international",
    )
    def build(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
        # A language listed twice counts as listed last, as in any JSON object.
        entries = F.map_entries(C(f"international.{source}"))
        last = F.filter(
            entries,
            lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]),
        )
        rows = docs.select(C("_id").alias(owner), F.explode(last).alias("e"))
        named = rows.select(owner, C("e.key").alias("language_code"), X.filled(C("e.value")).alias(column))
        return named.where(C(column).isNotNull())


international(
    "institution_international_name", "institutions", "institution_id", "institution_international_name", 200,
    "display_name",
)


@table(
    "institution_associated", "institutions",
    f"{INSTITUTION_ID}, associated_institution_seq smallint not null, associated_institution_id bigint, "
    "institution_relationship_type_id smallint",
    key="institution_id associated_institution_seq", reads="associated_institutions",
    catalogues=("institution_relationship_type",),
)
def institution_associated(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    rows = numbered(docs, [C("_id").alias("institution_id")], _associated(), "associated_institution_seq").select(
        "institution_id", "associated_institution_seq",
        C("item.id").alias("associated_institution_id"),
        C("item.relationship").alias("_relationship"),
    )
    return catalogue.lookup(
        rows, "institution_relationship_type", C("_relationship"), "institution_relationship_type_id"
    )


child(
    "institution_funder", "institutions", "institution_id", "funder_seq", "funder_id bigint", "roles",
    lambda: role_ids(C("roles"), "funder"),
)
child(
    "institution_publisher", "institutions", "institution_id", "publisher_seq", "publisher_id bigint", "roles",
    lambda: role_ids(C("roles"), "publisher"),
)
child(
    "institution_repository", "institutions", "institution_id", "repository_seq", "repository_source_id bigint",
    "repositories", lambda: not_null(F.transform(C("repositories"), lambda r: X.id_number(X.object_field(r, "id")))),
)
child(
    "institution_lineage", "institutions", "institution_id", "lineage_institution_seq",
    "lineage_institution_id bigint", "lineage", lambda: not_null(F.transform(C("lineage"), X.id_number)),
)
