"""Bronze layer: file queue state machine, raw-row maintenance, tenant registry
and the bronze reports.

Queue and tenant tables are metadata-sized; raw rows are the fact table, so
every raw-side operator aggregates or filters before it meets the queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions.dates import as_ts, seconds_between
from claimlake.functions.text import basename, file_type, first_segment, pct
from claimlake.operators.merge import insert_only, merge_upsert

MAX_ERROR_TEXT = 5000
MAX_RETRIES = 3


# -- discovery and batches -------------------------------------------------

def discover_files(listing: DataFrame, queue: DataFrame) -> DataFrame:
    """BRZ-1/2/3: stage files not yet queued, with tenant and type.

    An anti join, not ``NOT IN``: one NULL file name in the queue would
    otherwise empty the result.
    """
    known = queue.select("file_name").filter(F.col("file_name").isNotNull())
    new = listing.join(known, "file_name", "left_anti")
    return new.select("file_name", first_segment("file_name").alias("tpa"),
                      file_type("file_name").alias("file_type"),
                      F.col("size").alias("file_size_bytes"),
                      F.lit("PENDING").alias("status"))


def file_type_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy(file_type("file_name").alias("file_type")).agg(F.count(F.lit(1)).alias("files"))


def next_batch(queue: DataFrame, n: int = 10) -> DataFrame:
    """BRZ-4: the n oldest PENDING files (ties by queue id)."""
    return (queue.filter(F.col("status") == "PENDING")
                 .orderBy("discovered_timestamp", "queue_id").limit(n))


def skip_loaded(batch: DataFrame, raw: DataFrame) -> DataFrame:
    """BRZ-6: mark batch files already present in raw for their tenant, with row counts."""
    loaded = raw.groupBy("tpa", "file_name").agg(F.count(F.lit(1)).alias("loaded_rows"))
    return (batch.join(loaded, ["tpa", "file_name"], "left")
                 .withColumn("already_loaded", F.col("loaded_rows").isNotNull())
                 .withColumn("loaded_rows", F.coalesce("loaded_rows", F.lit(0))))


def merge_raw(raw: DataFrame, new_rows: DataFrame) -> DataFrame:
    """BRZ-7: insert-only merge on (file_name, file_row_number, tpa)."""
    return insert_only(raw, new_rows, ["file_name", "file_row_number", "tpa"])


# -- queue state machine -----------------------------------------------------

def result_status(result, strict_reference: bool = False):
    """SUCCESS... -> SUCCESS; SKIPPED... -> SKIPPED (FAILED in strict mode); else FAILED."""
    r = F.col(result) if isinstance(result, str) else result
    skipped = F.lit("FAILED") if strict_reference else F.lit("SKIPPED")
    return (F.when(r.startswith("SUCCESS"), F.lit("SUCCESS"))
             .when(r.startswith("SKIPPED"), skipped).otherwise(F.lit("FAILED")))


def apply_results(queue: DataFrame, results: DataFrame, as_of, strict_reference: bool = False) -> DataFrame:
    """BRZ-8: move processed files to SUCCESS/SKIPPED/FAILED; retry+1 on failure.

    ``results`` holds (queue_id, result text).  Error text is cut to 5000 chars.
    """
    r = results.select("queue_id", F.col("result").alias("_result"))
    j = queue.join(r, "queue_id", "left")
    hit = F.col("_result").isNotNull()
    st = result_status("_result", strict_reference)
    failed = st == "FAILED"
    cols = {
        "status": F.when(hit, st).otherwise(F.col("status")),
        "processed_timestamp": F.when(hit, as_ts(as_of)).otherwise(F.col("processed_timestamp")),
        "retry_count": F.when(hit & failed, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        "error_message": F.when(hit & (st != "SUCCESS"), F.substring("_result", 1, MAX_ERROR_TEXT))
                          .otherwise(F.col("error_message") if "error_message" in queue.columns else F.lit(None).cast("string")),
        "process_result": F.when(hit, F.substring("_result", 1, MAX_ERROR_TEXT))
                           .otherwise(F.col("process_result") if "process_result" in queue.columns else F.lit(None).cast("string")),
    }
    out = [cols.pop(c).alias(c) if c in cols else F.col(c) for c in queue.columns]
    out += [v.alias(k) for k, v in cols.items()]
    return j.select(*out)


def file_disposition(queue: DataFrame, n: int = 100) -> DataFrame:
    """BRZ-9: move lists; SUCCESS -> COMPLETED and FAILED with retry >= 3 -> ERROR (n each)."""
    done = (queue.filter(F.col("status") == "SUCCESS").orderBy("processed_timestamp", "queue_id").limit(n)
                 .select("queue_id", "file_name", "tpa", F.lit("COMPLETED").alias("target_stage")))
    err = (queue.filter((F.col("status") == "FAILED") & (F.col("retry_count") >= MAX_RETRIES))
                .orderBy("processed_timestamp", "queue_id").limit(n)
                .select("queue_id", "file_name", "tpa", F.lit("ERROR").alias("target_stage")))
    return done.unionByName(err)


def retention_plan(listing: DataFrame, as_of, archive_after_days: int = 30, purge_after_days: int = 90) -> DataFrame:
    """BRZ-10: COMPLETED/ERROR files older than 30 days -> ARCHIVE; ARCHIVE older than 90 -> PURGE."""
    age = F.datediff(as_ts(as_of).cast("date"), F.col("modification_time").cast("date"))
    stage = F.col("stage")
    action = (F.when(stage.isin("COMPLETED", "ERROR") & (age > archive_after_days), F.lit("ARCHIVE"))
               .when((stage == "ARCHIVE") & (age > purge_after_days), F.lit("PURGE")))
    return (listing.withColumn("age_days", age.cast("bigint")).withColumn("action", action)
                   .filter(F.col("action").isNotNull()))


def delete_files(raw: DataFrame, queue: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """BRZ-11 (bulk form): drop raw rows of (tpa, file) and mark the queue rows DELETED
    with the number of raw rows removed.  ``files`` has (tpa, file_name); file
    names are matched on the full name or on their basename."""
    wanted = files.select("tpa", F.col("file_name").alias("_k")).distinct()
    names = raw.select("tpa", "file_name").union(queue.select("tpa", "file_name")).distinct()
    either = names.select("tpa", "file_name", F.explode(F.array_distinct(F.array("file_name", basename("file_name")))).alias("_k"))
    f = either.join(wanted, ["tpa", "_k"], "left_semi").select("tpa", "file_name").distinct()
    counts = (raw.join(f, ["tpa", "file_name"], "left_semi")
                 .groupBy("tpa", "file_name").agg(F.count(F.lit(1)).alias("deleted_rows")))
    remaining = raw.join(f, ["tpa", "file_name"], "left_anti")
    q = (queue.join(f.withColumn("_hit", F.lit(True)), ["tpa", "file_name"], "left")
              .join(counts, ["tpa", "file_name"], "left"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = [F.when(hit, F.lit("DELETED")).otherwise(F.col(c)).alias(c) if c == "status" else F.col(c)
           for c in queue.columns]
    out.append(F.when(hit, F.coalesce("deleted_rows", F.lit(0))).alias("deleted_rows"))
    return remaining, q.select(*out)


def reset_stuck(queue: DataFrame, as_of, minutes: int = 5) -> DataFrame:
    """BRZ-12: PROCESSING with no processed time or older than 5 min -> PENDING."""
    now = as_ts(as_of)
    stuck = (F.col("status") == "PROCESSING") & (
        F.col("processed_timestamp").isNull() |
        (F.col("processed_timestamp") < F.timestamp_add("MINUTE", F.lit(-minutes), now)))
    return queue.withColumn("status", F.when(stuck, F.lit("PENDING")).otherwise(F.col("status")))


def reprocess(queue: DataFrame, ids: DataFrame) -> DataFrame:
    """BRZ-13: FAILED/SUCCESS files in ``ids`` -> PENDING, error/result/time cleared."""
    j = queue.join(ids.select("queue_id").distinct().withColumn("_hit", F.lit(True)), "queue_id", "left")
    go = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("status").isin("FAILED", "SUCCESS")
    out = []
    for c in queue.columns:
        if c == "status":
            out.append(F.when(go, F.lit("PENDING")).otherwise(F.col(c)).alias(c))
        elif c in ("error_message", "process_result", "processed_timestamp"):
            out.append(F.when(go, F.lit(None)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def unqueue(queue: DataFrame, files: DataFrame) -> DataFrame:
    """BRZ-14: PENDING/FAILED rows of the given files are removed, others -> DELETED."""
    j = queue.join(files.select("file_name").distinct().withColumn("_hit", F.lit(True)), "file_name", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    kept = j.filter(~(hit & F.col("status").isin("PENDING", "FAILED")))
    out = [F.when(hit, F.lit("DELETED")).otherwise(F.col(c)).alias(c) if c == "status" else F.col(c)
           for c in queue.columns]
    return kept.select(*out)


# -- reports -----------------------------------------------------------------

def status_summary(queue: DataFrame) -> DataFrame:
    """BRZ-15."""
    return queue.groupBy("status", "tpa").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size_bytes").cast("bigint").alias("total_bytes"),
        F.min("discovered_timestamp").alias("oldest_file"),
        F.max("discovered_timestamp").alias("newest_file"))


def recent_activity(queue: DataFrame, as_of, n: int = 100) -> DataFrame:
    """BRZ-16: newest n files; open files measured up to ``as_of``."""
    end = F.coalesce(F.col("processed_timestamp"), as_ts(as_of))
    return (queue.select("queue_id", "file_name", "tpa", "status", "discovered_timestamp", "processed_timestamp",
                         seconds_between("discovered_timestamp", end).alias("duration_seconds"))
                 .orderBy(F.col("discovered_timestamp").desc(), F.col("queue_id").desc()).limit(n))


def failed_files(queue: DataFrame) -> DataFrame:
    """BRZ-17."""
    return (queue.filter(F.col("status") == "FAILED")
                 .select("queue_id", "file_name", "tpa", "retry_count", "processed_timestamp")
                 .orderBy(F.col("processed_timestamp").desc(), "queue_id"))


def raw_statistics(raw: DataFrame) -> DataFrame:
    """BRZ-18."""
    return raw.groupBy("tpa", "file_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("file_name").alias("file_count"),
        F.min("load_timestamp").alias("first_load"), F.max("load_timestamp").alias("last_load"))


def bronze_stats(raw: DataFrame, tpa: str | None = None) -> DataFrame:
    """BRZ-19."""
    r = raw if tpa is None else raw.filter(F.col("tpa") == tpa)
    return r.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("file_name").alias("total_files"),
                 F.countDistinct("tpa").alias("total_tpas"),
                 F.min("load_timestamp").alias("earliest_load"), F.max("load_timestamp").alias("latest_load"))


def raw_browse(raw: DataFrame, tpa: str | None = None, file_name: str | None = None, n: int = 100) -> DataFrame:
    """BRZ-20: top-n raw rows by row number (record id breaks ties)."""
    r = raw
    if tpa is not None:
        r = r.filter(F.col("tpa") == tpa)
    if file_name is not None:
        r = r.filter(F.col("file_name") == file_name)
    return r.orderBy("file_row_number", "record_id").limit(n)


def queue_list(queue: DataFrame, tpa: str | None = None, n: int = 100) -> DataFrame:
    """BRZ-21."""
    q = queue if tpa is None else queue.filter(F.col("tpa") == tpa)
    return q.orderBy(F.col("discovered_timestamp").desc(), F.col("queue_id").desc()).limit(n)


def object_keys(raw: DataFrame, col: str = "raw_data") -> DataFrame:
    return raw.select("tpa", F.explode(F.json_object_keys(F.col(col))).alias("field_name"))


def source_fields(raw: DataFrame, tpa: str | None = None, n: int | None = None) -> DataFrame:
    """BRZ-22: distinct object keys per tenant; ``n`` shortens a display to the first n names per tenant."""
    r = raw if tpa is None else raw.filter(F.col("tpa") == tpa)
    keys = object_keys(r).distinct()
    if n is None:
        return keys
    from pyspark.sql import Window
    w = Window.partitionBy("tpa").orderBy("field_name")
    return keys.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def source_profile(raw: DataFrame, tpa: str | None = None) -> DataFrame:
    """BRZ-23: flattened record count (rows x keys) and distinct field count per tenant."""
    r = raw if tpa is None else raw.filter(F.col("tpa") == tpa)
    return (object_keys(r).groupBy("tpa")
                          .agg(F.count(F.lit(1)).alias("flattened_records"),
                               F.countDistinct("field_name").alias("distinct_fields")))


def tpa_statistics(master: DataFrame, raw: DataFrame, queue: DataFrame) -> DataFrame:
    """BRZ-24: registry with file/record counts and status counts.

    Each side is aggregated per tenant first, so counts do not multiply
    (the reference joins raw and queue rows before grouping).
    """
    r = raw.groupBy("tpa").agg(F.count(F.lit(1)).alias("total_records"),
                               F.countDistinct("file_name").alias("files_loaded"),
                               F.min("load_timestamp").alias("first_load"),
                               F.max("load_timestamp").alias("last_load"))
    q = queue.groupBy("tpa").agg(F.count(F.lit(1)).alias("files_queued"),
                                 F.count_if(F.col("status") == "SUCCESS").alias("files_success"),
                                 F.count_if(F.col("status") == "FAILED").alias("files_failed"),
                                 F.count_if(F.col("status") == "PENDING").alias("files_pending"))
    m = master.select(F.col("tpa_code").alias("tpa"), "tpa_name", "active")
    z = F.lit(0)
    return (m.join(r, "tpa", "left").join(q, "tpa", "left")
             .select("tpa", "tpa_name", "active",
                     F.coalesce("total_records", z).alias("total_records"),
                     F.coalesce("files_loaded", z).alias("files_loaded"), "first_load", "last_load",
                     F.coalesce("files_queued", z).alias("files_queued"),
                     F.coalesce("files_success", z).alias("files_success"),
                     F.coalesce("files_failed", z).alias("files_failed"),
                     F.coalesce("files_pending", z).alias("files_pending")))


# -- tenant registry -----------------------------------------------------------

def upsert_tpa(master: DataFrame, changes: DataFrame) -> DataFrame:
    """BRZ-25: upsert tenants; a match re-activates the tenant."""
    return merge_upsert(master, changes, ["tpa_code"], update_cols=[c for c in ("tpa_name",) if c in changes.columns],
                        when_matched={"active": F.lit(True)}, insert_cols={"active": F.lit(True)})


def set_tpa_active(master: DataFrame, codes: DataFrame, flag: bool) -> tuple[DataFrame, DataFrame]:
    """BRZ-26: (updated registry, codes not found)."""
    c = codes.select(F.col("tpa_code")).distinct()
    j = master.join(c.withColumn("_hit", F.lit(True)), "tpa_code", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = [F.when(hit, F.lit(flag)).otherwise(F.col(x)).alias(x) if x == "active" else F.col(x)
           for x in master.columns]
    return j.select(*out), c.join(master.select("tpa_code"), "tpa_code", "left_anti")


def active_tpas(master: DataFrame) -> DataFrame:
    """BRZ-27."""
    return master.filter(F.col("active")).orderBy("tpa_code")


def split_by_registered(df: DataFrame, master: DataFrame, col: str = "tpa") -> tuple[DataFrame, DataFrame]:
    """BRZ-28: rows of active registered tenants, and the rest."""
    act = master.filter(F.col("active")).select(F.col("tpa_code").alias(col))
    return df.join(act, col, "left_semi"), df.join(act, col, "left_anti")


def cascade_rename(tables: dict[str, DataFrame], old: str, new: str, col: str = "tpa",
                   master_key: str = "tpa_code") -> dict[str, DataFrame]:
    """BRZ-29: rename a tenant code in every table.  The caller refuses the
    rename when ``new`` exists (see :func:`rename_conflicts`)."""
    out = {}
    for name, df in tables.items():
        c = master_key if master_key in df.columns else col
        out[name] = df.withColumn(c, F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)))
    return out


def rename_tenant(store, old: str, new: str, batch_id: str, col: str = "tpa", master_key: str = "tpa_code") -> bool:
    """BRZ-29 over every table of a table set, switched by one manifest.

    Refused (ValueError) when the tenant list has ``new`` or any table holds rows of it: two tenants would run together.  A
    table without rows of ``old`` keeps its files.  False when the batch had been committed before.
    """
    def build(batch):
        plan = []
        for name in sorted(batch.tables):
            df = batch.read(name)
            c = master_key if master_key in df.columns else col if col in df.columns else None
            if c is None:
                continue
            # two numbers per table
            hit = df.agg(F.count_if(F.col(c) == old).alias("old"), F.count_if(F.col(c) == new).alias("new")).first()
            if hit["new"]:
                raise ValueError(f"{name} has rows of tenant {new}")
            if hit["old"]:
                plan.append((name, df))
        for name, df in plan:
            batch.rewrite(name, cascade_rename({name: df}, old, new, col, master_key)[name])
    return store.run(batch_id, build)


def rename_conflicts(master: DataFrame, new: str, key: str = "tpa_code") -> DataFrame:
    return master.filter(F.col(key) == new)


def cascade_delete_counts(tables: dict[str, DataFrame], tpa: str, col: str = "tpa") -> DataFrame:
    """BRZ-30: per-table count of rows a tenant delete removes (one aggregate per table)."""
    parts = [df.agg(F.count_if(F.col(col) == tpa).alias("deleted_rows"),
                    F.count_if(F.col(col) != tpa).alias("remaining_rows"))
               .select(F.lit(name).alias("table_name"), "deleted_rows", "remaining_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cascade_delete(tables: dict[str, DataFrame], tpa: str, col: str = "tpa") -> dict[str, DataFrame]:
    return {n: df.filter(~F.col(col).eqNullSafe(F.lit(tpa))) for n, df in tables.items()}


# -- KPIs --------------------------------------------------------------------

def queue_kpis(queue: DataFrame, statuses=None, types=None, tpas=None) -> DataFrame:
    """BRZ-31: counts per status and success rate (%, one decimal) under filters."""
    q = queue
    if statuses:
        q = q.filter(F.col("status").isin(list(statuses)))
    if types:
        q = q.filter(F.col("file_type").isin(list(types)))
    if tpas:
        q = q.filter(F.col("tpa").isin(list(tpas)))
    s = F.col("status")
    return q.agg(F.count(F.lit(1)).alias("total_files"),
                 F.count_if(s == "SUCCESS").alias("success_files"),
                 F.count_if(s == "FAILED").alias("failed_files"),
                 F.count_if(s == "PENDING").alias("pending_files"),
                 F.count_if(s == "PROCESSING").alias("processing_files"),
                 pct(F.count_if(s == "SUCCESS"), F.count(F.lit(1))).alias("success_rate"))


def raw_kpis(raw: DataFrame, tpas=None) -> DataFrame:
    """BRZ-32: rows, unique files, rows per type (as 'TYPE:n' list), date range.

    A file has exactly one type, so per-type distinct file counts add up to
    the total: one grouped pass, then a roll-up of at most a handful of rows.
    """
    r = raw if not tpas else raw.filter(F.col("tpa").isin(list(tpas)))
    per = r.groupBy("file_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file_name").alias("f"),
                                     F.min("load_timestamp").alias("lo"), F.max("load_timestamp").alias("hi"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
                   F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("unique_files"),
                   F.array_join(F.array_sort(F.collect_list(
                       F.concat(F.col("file_type"), F.lit(":"), F.col("n").cast("string")))), ",").alias("rows_by_type"),
                   F.min("lo").alias("first_load"), F.max("hi").alias("last_load"))


def landing_kpis(listing: DataFrame, tpas=None) -> DataFrame:
    """BRZ-34: file count and bytes per stage and tenant; tenant filter is
    case-insensitive; files without a tenant folder drop out."""
    rel = F.col("file_name")
    tpa = F.when(F.instr(rel, "/") > 0, first_segment(rel))
    l = listing.withColumn("tpa", tpa).filter(F.col("tpa").isNotNull())
    if tpas:
        l = l.filter(F.lower("tpa").isin([t.lower() for t in tpas]))
    return l.groupBy("stage", "tpa").agg(F.count(F.lit(1)).alias("file_count"),
                                         F.sum("size").cast("bigint").alias("total_bytes"))
