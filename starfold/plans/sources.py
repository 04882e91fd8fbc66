"""Tables of the sources entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import dense_distinct, let
from ..operators.catalogue import Catalogue, Feed
from .tables import child, table

C = F.col

FEEDS = (Feed("source_type", "sources", ("type",), lambda: F.array(C("type"))),)


@table(
    "source", "sources",
    "source_id bigint not null, source varchar(800), abbreviation varchar(200), source_type_id smallint, "
    "country_iso_alpha2_code char(3), host_organization_publisher_id bigint, "
    f"host_organization_institution_id bigint, homepage_url string, issn_l char(9), {SHORT_ID} varchar(11), "
    "mag_id bigint, wikidata_id varchar(10), fatcat_id char(26), is_in_doaj boolean, is_oa boolean, "
    "apc_price_usd int, updated_date date, created_date date",
    key="source_id",
    reads="display_name abbreviated_title type country_code host_organization publisher_id homepage_url issn_l "
    "is_in_doaj is_oa apc_usd ids updated_date created_date",
    catalogues=("source_type",),
)
def source(docs: DataFrame, catalogue: Catalogue) -> DataFrame:
    publisher = F.coalesce(X.id_with_letter(C("host_organization"), "P"), X.id_with_letter(C("publisher_id"), "P"))
    rows = docs.select(
        C("_id").alias("source_id"),
        C("display_name").alias("source"),
        C("abbreviated_title").alias("abbreviation"),
        C("country_code").alias("country_iso_alpha2_code"),
        publisher.alias("host_organization_publisher_id"),
        X.id_with_letter(C("host_organization"), "I").alias("host_organization_institution_id"),
        C("homepage_url"),
        X.issn(X.first_filled(C("issn_l"), C("ids.issn_l"))).alias("issn_l"),
        C("_short").alias(SHORT_ID),
        X.whole_of_json(C("ids.mag")).alias("mag_id"),
        X.last_segment(C("ids.wikidata")).alias("wikidata_id"),
        X.last_segment(C("ids.fatcat")).alias("fatcat_id"),
        X.flag_of_json(C("is_in_doaj")).alias("is_in_doaj"),
        X.flag_of_json(C("is_oa")).alias("is_oa"),
        X.whole_of_json(C("apc_usd")).alias("apc_price_usd"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
        C("type").alias("_type"),
    )
    return catalogue.lookup(rows, "source_type", C("_type"), "source_type_id")


child(
    "source_alternative_title", "sources", "source_id", "alternative_title_seq", "alternative_title varchar(700)",
    "alternate_titles", lambda: dense_distinct(C("alternate_titles")),
)


def _prices() -> Column:
    def parsed(p: Column) -> Column:
        return F.struct(
            let(X.object_value(p, "price"), X.whole_of_json).alias("apc_price"), X.filled(X.object_field(p, "currency")).alias("currency"),
            X.object_field(p, "price").alias("given"),
        )

    return F.filter(F.transform(C("apc_prices"), parsed), lambda p: p["given"].isNotNull() & p["currency"].isNotNull())


child(
    "source_apc_price", "sources", "source_id", "apc_price_seq", "apc_price int, currency char(3)",
    "apc_prices", _prices,
)
child(
    "source_issn", "sources", "source_id", "issn_seq", "issn char(9)", "issn ids",
    lambda: dense_distinct(F.transform(X.first_filled_array(C("issn"), C("ids.issn")), X.issn)),
)


def _societies() -> Column:
    def parsed(s: Column) -> Column:
        return F.struct(
            X.first_filled(X.object_field(s, "organization"), X.object_field(s, "name")).alias("society"),
            X.filled(X.object_field(s, "url")).alias("homepage_url"),
        )

    return F.filter(
        F.transform(C("societies"), parsed), lambda s: s["society"].isNotNull() | s["homepage_url"].isNotNull()
    )


child(
    "source_society", "sources", "source_id", "society_seq", "society varchar(500), homepage_url string",
    "societies", _societies,
)
