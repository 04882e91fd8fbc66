"""The training-data pipeline: documents through quality rules, line dedup, near-dedup,
mixing and encoding, each stage written as Parquet and read by the next.

Every stage works on all that its predecessor kept. Stages 1 to 4 return the columns of
documents: 1 drops what the rules reject, 2 takes repeated lines out of the texts (a
document that loses all its lines goes), 3 leaves one document of each group of
near-duplicates, 4 thins out domains that are over their target (no document is
repeated). Stage 5 returns the ids. Nulls and ties are treated as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import line_dedup, minhash, mixing, quality_rules, queries
from starfold.session import durable


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs, quality_rules.train(docs, _labels(spark, sf_dir)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_near_duplicates(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, _labels(spark, sf_dir), most=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every text; null text is empty."""
    return queries.encoded(docs).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", keep_quality), ("line dedup", drop_repeated_lines), ("near-dedup", drop_near_duplicates),
    ("mixing", mix_to_targets), ("encoding", encode),
]

#: Boosted trees, fitted rates and byte pair merges cannot be put as SQL; the tests hold
#: each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
