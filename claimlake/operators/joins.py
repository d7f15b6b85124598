"""Size-checked broadcast: broadcast a join side only when the files it is
built from are provably small; otherwise leave the join to the planner
(sort-merge / AQE), so nothing that grows with the data is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_MAX_BYTES = 32 << 20  # compressed parquet bytes


def path_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes under ``path`` (Hadoop file system); None when unknown."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
    except Exception:  # noqa: BLE001 - no JVM handle: size unknown
        return None


def broadcast_if_small(df: DataFrame, source_paths: list[str], max_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when the files ``df`` derives from total at most
    ``max_bytes`` (conf ``claimlake.broadcast.maxSourceBytes``), else ``df``.

    A join with foreign keys never has more rows than its sources, so the
    bound on the sources bounds the broadcast side.
    """
    spark = df.sparkSession
    if max_bytes is None:
        max_bytes = int(spark.conf.get("claimlake.broadcast.maxSourceBytes", str(DEFAULT_MAX_BYTES)))
    sizes = [path_bytes(spark, p) for p in source_paths]
    if any(x is None for x in sizes):
        return df  # size not proven: no broadcast
    return F.broadcast(df) if sum(sizes) <= max_bytes else df
