"""Session helpers: where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="starfold-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later plans start from the files: a lost executor costs no recomputation of
    the upstream plan, row numbers stay what they were when first computed, and
    the planner sees real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/starfold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share rows out over all cores when their source comes in few pieces.

    With at least as many pieces as cores there is nothing to gain from moving
    the rows, and none are moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def at_once(act: Callable, items: Iterable, threads: int = 4) -> list:
    """Run independent Spark actions side by side, so that the last tasks of one
    leave no cores idle; results in the order of ``items``."""
    with ThreadPoolExecutor(max(1, threads)) as pool:
        return list(pool.map(act, items))
