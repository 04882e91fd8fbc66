"""Tables made from several works at once."""

from __future__ import annotations

from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.arrays import let, not_null, numbered
from ..operators.catalogue import Catalogue
from ..session import durable
from .tables import table
from .works import WORK_ID, author_name, in_location, title, work_doi

C = F.col


def _author_ids() -> Column:
    ids = F.array_distinct(not_null(F.transform(C("authorships.author.id"), X.id_number)))
    return F.coalesce(ids, F.array().cast("array<bigint>"))


#: References carry up to so many author ids; those of wider works are looked up per pair.
WIDE = 64


def edges(docs: DataFrame) -> DataFrame:
    """References with the citing year and the years between; whether both works share
    an author (J7), or, where the citing work has more than ``WIDE`` authors, the authors
    of the cited one in ``_theirs`` and the citing document in ``_at``.

    Year and author ids of the citing work come from its own document, those of
    the cited work from one join on its id; no pairs of authors are formed.
    References without an id are spread over all tasks.  A work cited very often
    is split by the skew handling of adaptive execution, which needs both sides
    to come straight from a shuffle: the cited side is written down first.
    """
    year = X.whole_of_json(C("publication_year"))
    narrow = docs.select("_id", "_ord", year.alias("pub_year"), _author_ids().alias("_ids"), "referenced_works")
    keep = [C("_id").alias("citing_work_id"), C("_ord").alias("_at"), "pub_year", F.when(F.size("_ids") <= WIDE, C("_ids")).alias("_ours")]
    references = numbered(narrow, keep, C("referenced_works"), "reference_seq").select(
        "citing_work_id", "reference_seq", "pub_year", "_ours", "_at",
        X.id_number(C("item")).alias("cited_work_id"),
    )
    # Ids are never negative, so negative join keys match nothing.
    share = F.pmod(F.xxhash64("citing_work_id", "reference_seq"), F.lit(1 << 10))
    references = references.withColumn("_key", F.coalesce(C("cited_work_id"), -1 - share))
    # A work delivered twice must not double the references to it.
    cited = durable(
        docs.groupBy(C("_id").alias("_cited")).agg(
            F.min_by(F.struct(year.alias("year"), _author_ids().alias("authors")), "_ord").alias("_other")
        )
    )
    both = references.join(cited, C("_key") == C("_cited"), "left")
    wide = C("_other").isNotNull() & C("_ours").isNull()
    return both.select(
        "citing_work_id", "reference_seq", "cited_work_id", "pub_year",
        (C("pub_year") - C("_other.year")).alias("cit_window"),
        F.when(C("_other").isNotNull() & ~wide, F.arrays_overlap("_ours", "_other.authors")).alias("is_self_cit"),
        F.when(wide, C("_at")).alias("_at"),
        F.when(wide, C("_other.authors")).alias("_theirs"),
    )


_MADE: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()
_MAKING = Lock()


def citations(docs: DataFrame) -> DataFrame:
    """The edges, made once for the same documents however many tables read them.

    Few works are wide; only their references to works that are there bring the cited
    authors back to the citing document, whose own list is read once.
    """
    with _MAKING:
        if docs not in _MADE:
            _MADE[docs] = durable(edges(docs))
        made = _MADE[docs]
    plain = ["citing_work_id", "reference_seq", "cited_work_id", "pub_year", "cit_window", "is_self_cit"]
    ids = _author_ids()
    wide = docs.where(F.size(ids) > WIDE).select(C("_ord").alias("_at"), ids.alias("_ours"))
    tested = made.where(C("_theirs").isNotNull()).join(wide, "_at").withColumn("is_self_cit", F.arrays_overlap("_ours", "_theirs"))
    return made.where(C("_theirs").isNull()).select(plain).unionByName(tested.select(plain))


@table(
    "citation", "works",
    "citing_work_id bigint not null, reference_seq int not null, cited_work_id bigint, pub_year smallint, "
    "cit_window smallint, is_self_cit boolean",
    key="citing_work_id reference_seq", reads="publication_year authorships referenced_works",
)
def citation(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    return citations(docs)


def shortened(names: Column) -> Column:
    """Names joined by ``; ``; of more than four, the first three, ``...`` and the last."""
    return let(
        names,
        lambda n: F.array_join(
            F.when(
                F.size(n) > 4,
                F.concat(F.slice(n, 1, 3), F.array(F.lit("...")), F.slice(n, -1, 1)),
            ).otherwise(n),
            "; ",
        ),
    )


def _others(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array), F.lit(0)))


@table(
    "work_detail", "works",
    f"{WORK_ID}, author_first varchar(1000), author_et_al varchar(800), institution_first varchar(200), "
    "institution_et_al varchar(500), title string, source varchar(800), pub_year smallint, volume varchar(200), "
    "issue varchar(80), pages varchar(350), doi varchar(330), pmid bigint, work_type varchar(25), n_cits int, "
    "n_self_cits int",
    key="work_id",
    reads="authorships title display_name primary_location publication_year biblio doi ids type cited_by_count "
    "referenced_works",
)
def work_detail(docs: DataFrame, _catalogue: Catalogue) -> DataFrame:
    """T84.  ``n_self_cits`` counts the citations by works that share an author."""
    empty = F.array().cast("array<string>")
    names = F.coalesce(F.transform(_others(C("authorships")), author_name), empty)
    institutions = F.get(C("authorships"), F.lit(0))["institutions"]["display_name"]
    rows = docs.select(
        C("_id").alias("work_id"),
        author_name(F.get(C("authorships"), F.lit(0))).alias("author_first"),
        shortened(not_null(names)).alias("author_et_al"),
        F.get(institutions, F.lit(0)).alias("institution_first"),
        F.array_join(
            F.filter(F.coalesce(_others(institutions), empty), lambda n: n != ""), "; "
        ).alias("institution_et_al"),
        title().alias("title"),
        in_location(C("primary_location"), "source.display_name").alias("source"),
        X.whole_of_json(C("publication_year")).alias("pub_year"),
        C("biblio.volume").alias("volume"),
        C("biblio.issue").alias("issue"),
        X.page_range(C("biblio.first_page"), C("biblio.last_page")).alias("pages"),
        work_doi().alias("doi"),
        X.longest_number(C("ids.pmid")).alias("pmid"),
        C("type").alias("work_type"),
        X.whole_of_json(C("cited_by_count")).alias("n_cits"),
    )
    # Counting by cited work shrinks in each task before it is shuffled.
    counts = (
        citations(docs)
        .where(C("is_self_cit"))
        .groupBy(C("cited_work_id").alias("work_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    joined = rows.join(counts, "work_id", "left")
    return joined.withColumn("n_self_cits", F.coalesce("_n", F.lit(0)))
