"""Tables of the authors entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import first_positions, not_null, numbered
from ..operators.catalogue import Catalogue
from .tables import child, table

C = F.col
AUTHOR_ID = "author_id bigint not null"


@table(
    "author", "authors",
    f"{AUTHOR_ID}, author string, orcid char(19), {SHORT_ID} varchar(11), scopus_id bigint, "
    "wikipedia_url varchar(200), updated_date date, created_date date",
    key="author_id", reads="display_name orcid ids updated_date created_date",
)
def author(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return docs.select(
        C("_id").alias("author_id"),
        C("display_name").alias("author"),
        X.orcid(X.first_filled(C("orcid"), C("ids.orcid"))).alias("orcid"),
        C("_short").alias(SHORT_ID),
        X.scopus_author(C("ids.scopus")).alias("scopus_id"),
        C("ids.wikipedia").alias("wikipedia_url"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
    )


@table(
    "author_alternative_name", "authors",
    f"{AUTHOR_ID}, alternative_name_seq smallint not null, alternative_name varchar(255)",
    key="author_id alternative_name_seq", reads="display_name_alternatives",
)
def author_alternative_name(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    """Repeats go, the others keep their place, gaps included."""
    rows = docs.select(
        C("_id").alias("author_id"), F.explode(first_positions(C("display_name_alternatives"))).alias("e")
    )
    return rows.select(
        "author_id", C("e.seq").alias("alternative_name_seq"), C("e.item").alias("alternative_name")
    )


def _affiliations() -> Column:
    """Affiliations with an institution number: ``(institution_id, years)``."""
    def parsed(a: Column) -> Column:
        years = F.from_json(F.get_json_object(a, "$.years"), "array<variant>")
        number = F.when(X.is_object(a), X.id_number(F.get_json_object(a, "$.institution.id")))
        return F.struct(number.alias("institution_id"), years.alias("years"))

    return F.filter(F.transform(C("affiliations"), parsed), lambda a: a["institution_id"].isNotNull())


def _institution_numbers() -> Column:
    def number(a: Column) -> Column:
        return F.when(X.is_object(a), X.id_number(F.get_json_object(a, "$.institution.id")))

    return not_null(F.transform(C("affiliations"), number))


child(
    "author_institution", "authors", "author_id", "institution_seq", "institution_id bigint",
    "affiliations", _institution_numbers,
)


@table(
    "author_institution_year", "authors",
    f"{AUTHOR_ID}, institution_seq smallint not null, year_seq smallint not null, year smallint",
    key="author_id institution_seq year_seq", reads="affiliations",
)
def author_institution_year(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    """Dense numbers on both levels."""
    outer = numbered(docs, [C("_id").alias("author_id")], _affiliations(), "institution_seq")
    years = not_null(F.transform(C("item.years"), X.whole_of_json))
    return numbered(outer, ["author_id", "institution_seq"], years, "year_seq", "year")


def _last_known() -> Column:
    """The single institution in front of the list; distinct ids."""
    single = F.array(C("last_known_institution"))
    listed = F.from_json(C("last_known_institutions"), "array<string>")
    both = F.concat(single, F.coalesce(listed, F.array().cast("array<string>")))
    return F.array_distinct(not_null(F.transform(both, lambda x: X.id_number(X.object_field(x, "id")))))


child(
    "author_last_known_institution", "authors", "author_id", "last_known_institution_seq",
    "last_known_institution_id bigint", "last_known_institution last_known_institutions", _last_known,
)
