"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session defaults the operators rely on: UTC wall clock (driver timestamps are
# NTZ and oracle comparisons run in UTC), ANSI on, AQE with skew-join handling,
# dynamic partition overwrite for the merge emulation.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "claimlake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`DEFAULT_CONF`."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset; it gets a fresh folder
    under the system temp root.  On a cluster such a folder would be another
    one on each machine, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="claimlake-ckpt-")
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def dropped_shuffles(spark):
    """Shuffle files of a write inside go when the write ends; else they stay until the driver happens to collect its garbage,
    which does not depend on their size.  Only what the write itself shuffled goes: another use of its frame has its own."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_work(df, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet of the shared folder, packed with zstd; nothing but the table is left of the write."""
    with dropped_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*partition_by or []).parquet(path)


def delete_path(spark, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


def written(df, name: str, path: str | None = None):
    """The rows as a table in the shared folder: computed once (a checkpoint computes them twice) and read back."""
    path = path or f"{checkpoint_dir(df.sparkSession).rstrip('/')}/claimlake-{name}-{uuid.uuid4().hex}"
    write_work(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames) -> None:
    """Deletes tables that ``written`` made and nothing will read again."""
    for df in frames:
        delete_path(df.sparkSession, df.stored_at)


@contextmanager
def open_files(spark, n: int = 8):
    """Partitioned writes inside keep up to ``n`` files of a task open, so its rows need no sort; a task with more values sorts the rest."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, "0")
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_bytes(spark, n: int):
    """Actions inside hand Python batches of about ``n`` bytes at most (a longer row is one of its own), however long the rows are."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
