"""Tables of the funders and publishers entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import dense_distinct
from ..operators.catalogue import Catalogue
from .institutions import role_ids
from .tables import child, table

C = F.col

_PICTURES = "image_url varchar(700), thumbnail_url varchar(1200), updated_date date, created_date date"


@table(
    "funder", "funders",
    "funder_id bigint not null, funder varchar(200), country_iso_alpha2_code char(3), description varchar(250), "
    f"homepage_url string, ror_id varchar(9), {SHORT_ID} varchar(11), wikidata_id varchar(10), {_PICTURES}",
    key="funder_id",
    reads="display_name country_code description homepage_url ror ids image_url image_thumbnail_url updated_date "
    "created_date",
)
def funder(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return docs.select(
        C("_id").alias("funder_id"),
        C("display_name").alias("funder"),
        C("country_code").alias("country_iso_alpha2_code"),
        C("description"),
        C("homepage_url"),
        X.last_segment(X.first_filled(C("ids.ror"), C("ror"))).alias("ror_id"),
        C("_short").alias(SHORT_ID),
        X.last_segment(C("ids.wikidata")).alias("wikidata_id"),
        C("image_url"),
        C("image_thumbnail_url").alias("thumbnail_url"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
    )


child(
    "funder_alternative_name", "funders", "funder_id", "alternative_name_seq", "alternative_name varchar(500)",
    "alternate_titles", lambda: dense_distinct(C("alternate_titles")),
)
child(
    "funder_publisher", "funders", "funder_id", "publisher_seq", "publisher_id bigint", "roles",
    lambda: role_ids(C("roles"), "publisher"),
)


@table(
    "publisher", "publishers",
    "publisher_id bigint not null, publisher varchar(200), hierarchy_level smallint, parent_publisher_id bigint, "
    f"homepage_url string, ror_id varchar(9), {SHORT_ID} varchar(11), wikidata_id varchar(10), {_PICTURES}",
    key="publisher_id",
    reads="display_name hierarchy_level parent_publisher homepage_url ids image_url image_thumbnail_url "
    "updated_date created_date",
)
def publisher(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return docs.select(
        C("_id").alias("publisher_id"),
        C("display_name").alias("publisher"),
        X.whole_of_json(C("hierarchy_level")).alias("hierarchy_level"),
        X.id_number(X.object_field(C("parent_publisher"), "id")).alias("parent_publisher_id"),
        C("homepage_url"),
        X.last_segment(C("ids.ror")).alias("ror_id"),
        C("_short").alias(SHORT_ID),
        X.last_segment(C("ids.wikidata")).alias("wikidata_id"),
        C("image_url"),
        C("image_thumbnail_url").alias("thumbnail_url"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
    )


child(
    "publisher_alternative_name", "publishers", "publisher_id", "alternative_name_seq",
    "alternative_name varchar(150)", "alternate_titles", lambda: dense_distinct(C("alternate_titles")),
)
child(
    "publisher_country", "publishers", "publisher_id", "country_seq", "country_iso_alpha2_code char(3)",
    "country_codes", lambda: dense_distinct(C("country_codes")),
)
