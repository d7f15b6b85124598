"""Helpers shared by the operators: tables, the shared work folder, row identity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import checkpoint_dir, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, as Spark reads it (any file system).

    A table with fewer scan tasks than the session has cores is spread by a
    round-robin exchange; larger inputs keep their splits (no shuffle).
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df)


def spread(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) < want and df._jdf.queryExecution().toRdd().getNumPartitions() < want:
        return df.repartition(want)
    return df


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that all executors share
    (``spark.checkpoint.dir``); never a machine-local temp folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage with a
    table that survives the loss of any executor; the shuffles that made it go at once."""
    return written(df, name, work_path(df.sparkSession, name))


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of explicit exchanges: the session's shuffle width, at least two per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
