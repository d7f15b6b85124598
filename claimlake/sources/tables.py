"""Reading the parquet tables of a data folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables below this size are dimension-sized: never spread.
SPREAD_MIN_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    df = spark.read.parquet(path)
    return spread_scan(df, path)


def spread_scan(df: DataFrame, path: str) -> DataFrame:
    """Give a scan at least the session's parallelism.

    A file with a single row group scans in one task, so everything chained
    before the first shuffle would run on one core.  When a non-trivial input
    yields fewer scan partitions than the default parallelism, the rows are
    spread once right after the scan.  Large inputs (many files / row groups)
    already scan in many tasks and are left untouched -- no extra shuffle.
    """
    spark = df.sparkSession
    if spark.conf.get("claimlake.spreadScans", "true") != "true":
        return df
    from claimlake.operators.joins import path_bytes
    size = path_bytes(spark, path)
    if size is None:
        return df
    if size < SPREAD_MIN_BYTES:
        return df
    try:
        want = spark.sparkContext.defaultParallelism
        have = df._jdf.queryExecution().executedPlan().execute().getNumPartitions()
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. a remote session): leave the scan as is
        return df
    if have >= want:
        return df
    # hash of the leading (key) column: deterministic on recomputation, no
    # sort (a round-robin repartition sorts every row first), and only that
    # one column is added to what the scan must read
    from pyspark.sql import functions as F
    return df.repartition(want, F.xxhash64(F.col(df.columns[0])))
