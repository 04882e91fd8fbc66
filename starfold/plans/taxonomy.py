"""Tables of domains, fields, subfields and topics (T55-T69), from one rule.

Each level is a numbered entity with links to the levels above, to the level
below and to its siblings; ids fit a small integer, and the short id column
holds the number itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import SHORT_ID
from ..functions import text as X
from ..functions.arrays import dense_distinct, present
from ..operators.catalogue import Catalogue
from .concepts import element_numbers
from .tables import child, table

C = F.col

LEVELS = ("domain", "field", "subfield", "topic")


def _level(place: int) -> None:
    name = LEVELS[place]
    above, lowest = LEVELS[:place], name == LEVELS[-1]
    entity, key = f"{name}s", f"{name}_id"

    def level(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
        wikidata = [] if lowest else [X.last_segment(C("ids.wikidata")).alias("wikidata_id")]
        return docs.select(
            C("_id").alias(key),
            C("display_name").alias(name),
            C("description"),
            C("_id").alias(SHORT_ID),
            *wikidata,
            C("ids.wikipedia").alias("wikipedia_url"),
            *[X.id_number(C(f"{a}.id")).alias(f"{a}_id") for a in above],
            X.day(C("updated_date")).alias("updated_date"),
            X.day(C("created_date")).alias("created_date"),
        )

    columns = [
        f"{key} smallint not null", f"{name} varchar(120)",
        f"description varchar({1000 if lowest else 250})", f"{SHORT_ID} smallint",
        *([] if lowest else ["wikidata_id varchar(10)"]),
        "wikipedia_url varchar(200)", *[f"{a}_id smallint" for a in above],
        "updated_date date", "created_date date",
    ]
    reads = ["display_name", "description", "ids", *above, "updated_date", "created_date"]
    table(name, entity, ", ".join(columns), key=key, reads=" ".join(reads))(level)

    if lowest:
        child(
            "topic_keyword", entity, key, "keyword_seq", "keyword varchar(100)", "keywords",
            lambda: present(C("keywords")), "smallint",
        )
    else:
        below = LEVELS[place + 1]
        child(
            f"{name}_alternative_name", entity, key, "alternative_name_seq", "alternative_name varchar(255)",
            "display_name_alternatives", lambda: dense_distinct(C("display_name_alternatives")), "smallint",
        )
        child(
            f"{name}_{below}", entity, key, f"{below}_seq", f"{below}_id smallint", f"{below}s",
            lambda: element_numbers(f"{below}s"), "smallint",
        )
    child(
        f"{name}_sibling", entity, key, f"sibling_{name}_seq", f"sibling_{name}_id smallint", "siblings",
        lambda: element_numbers("siblings"), "smallint",
    )


for _place in range(len(LEVELS)):
    _level(_place)
