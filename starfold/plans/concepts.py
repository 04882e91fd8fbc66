"""Tables of the concepts entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import not_null, present
from ..operators.catalogue import Catalogue
from .institutions import international
from .tables import child, table

C = F.col


@table(
    "concept", "concepts",
    f"concept_id bigint not null, concept varchar(120), description varchar(250), level smallint, {SHORT_ID} varchar(11), "
    "mag_id bigint, wikidata_id varchar(10), wikipedia_url varchar(200), image_url varchar(700), "
    "thumbnail_url varchar(900), updated_date date, created_date date",
    key="concept_id",
    reads="display_name description level wikidata ids image_url image_thumbnail_url updated_date created_date",
)
def concept(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return docs.select(
        C("_id").alias("concept_id"),
        C("display_name").alias("concept"),
        C("description"),
        X.whole_of_json(C("level")).alias("level"),
        C("_short").alias(SHORT_ID),
        X.whole_of_json(C("ids.mag")).alias("mag_id"),
        X.last_segment(X.first_filled(C("ids.wikidata"), C("wikidata"))).alias("wikidata_id"),
        C("ids.wikipedia").alias("wikipedia_url"),
        C("image_url"),
        C("image_thumbnail_url").alias("thumbnail_url"),
        X.day(C("updated_date")).alias("updated_date"),
        X.day(C("created_date")).alias("created_date"),
    )


def element_numbers(array: str) -> Column:
    """Id numbers of elements that are objects or ids."""
    return not_null(F.transform(C(array), lambda x: X.id_number(X.element_id(x))))


child(
    "concept_ancestor", "concepts", "concept_id", "ancestor_concept_seq", "ancestor_concept_id bigint",
    "ancestors", lambda: element_numbers("ancestors"),
)
international(
    "concept_international_name", "concepts", "concept_id", "concept_international_name", 200, "display_name"
)
international(
    "concept_international_description", "concepts", "concept_id", "concept_international_description", 800,
    "description",
)


def _related() -> Column:
    def parsed(x: Column) -> Column:
        return F.struct(
            X.id_number(X.object_field(x, "id")).alias("related_concept_id"),
            X.decimal_number(X.object_field(x, "score")).alias("score"),
        )

    return F.filter(F.transform(C("related_concepts"), parsed), lambda r: r["related_concept_id"].isNotNull())


child(
    "concept_related", "concepts", "concept_id", "related_concept_seq", "related_concept_id bigint, score double",
    "related_concepts", _related,
)
child(
    "concept_umls_aui", "concepts", "concept_id", "umls_aui_seq", "umls_aui varchar(9)", "ids",
    lambda: present(C("ids.umls_aui")),
)
child(
    "concept_umls_cui", "concepts", "concept_id", "umls_cui_seq", "umls_cui char(8)", "ids",
    lambda: present(C("ids.umls_cui")),
)
