"""Joins that stay safe when a side grows or a key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NULL_SHARES = 1 << 10


def known_small(spark: SparkSession) -> int:
    """Bytes up to which a side of known size may be broadcast."""
    return int(spark.conf.get("starfold.broadcastBytes", str(32 << 20)))


def text_bytes(df: DataFrame, column: str) -> int:
    """Size of a text column with some overhead per row: one aggregated number."""
    size = F.sum(F.octet_length(column).cast("bigint") + 32)
    return df.agg(F.coalesce(size, F.lit(0)).alias("n")).first()["n"]


def drop_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Anti join on one text key; the list is broadcast only when measured small."""
    if text_bytes(listed, key) <= known_small(df.sparkSession):
        listed = F.broadcast(listed)
        return df.join(listed, key, "left_anti")
    return left_with_nulls_spread(df, F.col(key), listed.withColumnRenamed(key, "_listed"), "_listed", "left_anti")


def left_with_nulls_spread(
    df: DataFrame, value: Column, side: DataFrame, key: str, how: str = "left"
) -> DataFrame:
    """Shuffled left join on ``value = side[key]``.

    Rows without a value match nothing but would all go to one task; a second,
    constant-for-matches join key shares them out.  Hot values are split by the
    skew handling of adaptive execution, as the other side holds each key once.
    """
    share = F.when(value.isNull(), F.pmod(F.xxhash64(*df.columns[:2]), F.lit(_NULL_SHARES))).otherwise(F.lit(0))
    left = df.withColumn("_value", value).withColumn("_share", share)
    right = side.withColumn("_zero", F.lit(0).cast("bigint"))
    joined = left.join(right, (left["_value"] == right[key]) & (left["_share"] == right["_zero"]), how)
    return joined.drop("_value", "_share", "_zero", key)
