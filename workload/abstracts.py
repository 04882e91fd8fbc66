"""Works with an abstract, made from the given texts, one work per text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.fixed import WHITE_SPACE
from starfold.functions.arrays import let
from starfold.session import spread


def abstract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose inverted index lists each word of a text with its places.

    The index is made inside the row: (word, place) pairs are sorted, and each
    run of equal words becomes one entry.
    """
    texts = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    words = F.filter(F.split("text", f"[{WHITE_SPACE}]+"), lambda w: w != "")
    pairs = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("place"))))

    def index(sorted_pairs):
        def starts(p, j):
            return (j == 0) | (F.get(sorted_pairs, j - 1)["word"] != p["word"])

        first = F.filter(
            F.transform(sorted_pairs, lambda p, j: F.when(starts(p, j), j)), lambda j: j.isNotNull()
        )
        return let(
            first,
            lambda at: F.transform(
                at,
                lambda j, n: F.struct(
                    F.get(sorted_pairs, j)["word"].alias("key"),
                    F.transform(
                        F.slice(sorted_pairs, j + 1, F.coalesce(F.get(at, n + 1), F.size(sorted_pairs)) - j),
                        lambda p: p["place"],
                    ).alias("value"),
                ),
            ),
        )

    entries = F.map_from_entries(let(pairs, index))
    document = F.struct(
        F.concat(F.lit("W"), F.col("doc_id")).alias("id"), entries.alias("abstract_inverted_index")
    )
    return texts.select(F.col("doc_id").alias("_ord"), F.to_json(document).alias("value"))
