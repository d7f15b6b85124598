"""BRZ-33: continuous ingest of landing files into the raw table.

A ``binaryFile`` stream lists new files (only ``path`` is selected, so file
contents are not read by the listing); each micro-batch reads its files with
the header-aware CSV scan into a folder of its own (``batch_id=...``) and then
commits the folder and one ledger row per file at once.  A file counts as loaded when
the ledger has it, however many of its rows were written before a crash; the
next batch deletes folders that were never committed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.operators.store import TableSet
from claimlake.session import open_files, write_work
from claimlake.sources.landing import below, read_landing_csv

BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
RAW_SCHEMA = "tpa string, file_name string, file_row_number long, file_type string, raw_data string"
LEDGER_SCHEMA = "file_name string, tpa string, batch_id string, status string, rows_loaded bigint"
LEDGER_BUCKETS = 16


def ledger(spark: SparkSession, raw_path: str) -> TableSet:
    """The ledger beside a raw table: one row per loaded file (SUCCESS, or EMPTY when it had no rows)."""
    return TableSet(spark, raw_path.rstrip("/") + "-ledger")


def read_ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    return ledger(spark, raw_path).read("files", LEDGER_SCHEMA)


def _abandoned(store: TableSet, raw_path: str) -> list[str]:
    """Folders of batches that were prepared and never committed (one writer at a time, so none is being written)."""
    done = set(store.state()["batches"])
    return [f"{raw_path}/{c}" for c in store._children(raw_path) if c.startswith("batch_id=") and c.split("=", 1)[1] not in done]


def ingest_batch(spark: SparkSession, root: str, raw_path: str, paths: list[str], batch_id,
                 partition_dirs: bool = False) -> int:
    """Load the files of ``paths`` that the ledger does not have; returns how many it loaded."""
    raw_path, store = raw_path.rstrip("/"), ledger(spark, raw_path)
    for folder in _abandoned(store, raw_path):
        store._delete(folder)
    if not paths:
        return 0
    names = spark.createDataFrame([(p,) for p in paths], "path string").select("path", below(spark, F.col("path"), root.rstrip("/")).alias("file_name"))
    by_name = {r["file_name"]: r["path"] for r in names.collect()}  # one micro-batch's files
    loaded = {r["file_name"] for r in store.read("files", LEDGER_SCHEMA).filter(F.col("file_name").isin(list(by_name))).select("file_name").collect()}
    new = {n: p for n, p in by_name.items() if n not in loaded}
    if not new:
        return 0
    name = f"{batch_id}-{uuid.uuid4().hex[:8]}"
    lines = f"{store.root}-lines-{name}"
    rows = read_landing_csv(spark, root, paths=sorted(new.values()), partition_dirs=partition_dirs, work=lines)
    with open_files(spark):  # a split's lines are of one file, so of one tenant
        write_work(rows, f"{raw_path}/batch_id={name}", ["tpa"])  # prepared

    def commit(b) -> None:
        back = spark.read.schema(RAW_SCHEMA).parquet(f"{raw_path}/batch_id={name}") if store._children(f"{raw_path}/batch_id={name}") else spark.createDataFrame([], RAW_SCHEMA)
        counts = back.groupBy("file_name").agg(F.first("tpa").alias("tpa"), F.count(F.lit(1)).alias("n"))
        files = spark.createDataFrame([(n,) for n in sorted(new)], "file_name string").join(counts, "file_name", "left")
        b.upsert("files", files.select("file_name", "tpa", F.lit(name).alias("batch_id"), F.when(F.col("n").isNull(), "EMPTY").otherwise("SUCCESS").alias("status"),
                                       F.coalesce("n", F.lit(0)).cast("bigint").alias("rows_loaded")), ["file_name"], LEDGER_BUCKETS)
    store.run(name, commit)
    for work in (lines, lines + "-splits", lines + "-heads", lines + "-records"):
        store._delete(work)
    return len(new)


def stream_ingest(spark: SparkSession, root: str, raw_path: str, checkpoint: str,
                  max_files_per_trigger: int = 1000, available_now: bool = True, partition_dirs: bool = False):
    """Start (and with ``available_now`` run to completion) the ingest stream."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("recursiveFileLookup", True)
                  .option("pathGlobFilter", "*.[cC][sS][vV]*").option("maxFilesPerTrigger", max_files_per_trigger)
                  .load(root.rstrip("/")).select("path"))

    def on_batch(df: DataFrame, batch_id: int) -> None:
        # one row per new file, at most max_files_per_trigger: file metadata,
        # which the CSV reader needs on the driver anyway
        paths = sorted(r.path for r in df.collect())
        ingest_batch(df.sparkSession, root, raw_path, paths, batch_id, partition_dirs)

    w = files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
