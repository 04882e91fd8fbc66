"""Dense ids for distinct values (A1, A2, O1): rank by case-folded text, then text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable


@F.pandas_udf(T.StringType())
def casefold(texts: pd.Series) -> pd.Series:
    """Full Unicode case folding, which Spark lacks; used on distinct values only."""
    return texts.str.casefold()


def dense_ids(
    values: DataFrame, group: str = "catalogue", value: str = "value"
) -> tuple[DataFrame, dict[str, int]]:
    """``(group, value, id)`` with ids 1..n inside each group, for distinct rows;
    and the bytes of text in each group.

    No task sees all values: a range shuffle cuts the sorted order into even
    pieces wherever the values fall, and each row is numbered inside its piece.
    The pieces are written down before they are measured, so that sizes and rows
    agree even when tasks are run again.
    """
    order = [group, "_fold", value]
    pieces = durable(
        values.withColumn("_fold", casefold(value))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            group,
            value,
            F.spark_partition_id().alias("_piece"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    # One row per piece and group comes back: as many as partitions, whatever the data.
    sizes = (
        pieces.groupBy(group, "_piece")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_row").alias("first"),
            F.sum(F.octet_length(value).cast("bigint") + 32).alias("bytes"),
        )
        .orderBy(group, "_piece")
        .collect()
    )
    shifts, total, size = [], {}, {}
    for s in sizes:
        shifts.append((s[group], s["_piece"], total.get(s[group], 0) - s["first"] + 1))
        total[s[group]] = total.get(s[group], 0) + s["n"]
        size[s[group]] = size.get(s[group], 0) + s["bytes"]
    offsets = values.sparkSession.createDataFrame(
        shifts, T.StructType([pieces.schema[group], pieces.schema["_piece"], T.StructField("_shift", T.LongType())])
    )
    ids = pieces.join(F.broadcast(offsets), [group, "_piece"]).select(
        group, value, (F.col("_row") + F.col("_shift")).alias("id")
    )
    return ids, size
