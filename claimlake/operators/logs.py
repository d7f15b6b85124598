"""Log analytics over append-only log tables (application, task, error,
file processing and API request logs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.functions.dates import as_ts, boundary_diff


def recent_logs(df: DataFrame, as_of, days: int = 7, ts_col: str = "log_timestamp", n: int | None = None,
                like: dict | None = None, min_values: dict | None = None, id_col: str | None = None,
                **eq) -> DataFrame:
    """LOG-1..5: last ``days`` days up to ``as_of``; equality, LIKE and minimum
    filters; newest first, top ``n`` (ties by ``id_col``)."""
    now = as_ts(as_of)
    out = df.filter((F.col(ts_col) >= F.timestamp_add("DAY", F.lit(-days), now)) & (F.col(ts_col) <= now))
    for c, v in eq.items():
        if v is not None:
            out = out.filter(F.col(c) == v)
    for c, pat in (like or {}).items():
        out = out.filter(F.col(c).like(pat))
    for c, v in (min_values or {}).items():
        out = out.filter(F.col(c) >= v)
    order = [F.col(ts_col).desc()] + ([F.col(id_col).desc()] if id_col else [])
    out = out.orderBy(*order)
    return out.limit(n) if n else out


def file_summary(file_log: DataFrame, as_of, days: int = 7) -> DataFrame:
    """LOG-6: per file of the last ``days`` days: stages, those ok / failed, last time, rows processed / failed;
    the latest file first (ties by name and tenant)."""
    st, now = F.col("status"), as_ts(as_of)
    recent = file_log.filter((F.col("log_timestamp") >= F.timestamp_add("DAY", F.lit(-days), now)) & (F.col("log_timestamp") <= now))
    return recent.groupBy("file_name", "tpa").agg(
        F.count(F.lit(1)).alias("total_stages"),
        F.count_if(st == "SUCCESS").alias("stages_ok"),
        F.count_if(st == "FAILED").alias("stages_failed"),
        F.max("log_timestamp").alias("last_activity"),
        F.sum("rows_processed").cast("bigint").alias("rows_processed"),
        F.sum("rows_failed").cast("bigint").alias("rows_failed")) \
        .orderBy(F.desc("last_activity"), "file_name", "tpa")


def log_stats(app: DataFrame, task: DataFrame, err: DataFrame, as_of, days: int = 7) -> DataFrame:
    """LOG-7: three conditional-count branches, unioned."""
    now = as_ts(as_of)

    def window(df, ts):
        return df.filter((F.col(ts) >= F.timestamp_add("DAY", F.lit(-days), now)) & (F.col(ts) <= now))

    a = window(app, "log_timestamp").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("log_level") == "ERROR").alias("errors"),
        F.count_if(F.col("log_level") == "WARNING").alias("warnings")).select(F.lit("application").alias("log_type"), "*")
    t = window(task, "start_time").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "FAILED").alias("errors"),
        F.count_if(F.col("status") == "PROCESSING").alias("warnings")).select(F.lit("task").alias("log_type"), "*")
    e = window(err, "error_timestamp").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(~F.col("resolved")).alias("errors"),
        F.count_if(F.col("resolved")).alias("warnings")).select(F.lit("error").alias("log_type"), "*")
    return a.unionByName(t).unionByName(e)


def close_runs(starts: DataFrame, ends: DataFrame, id_col: str = "run_id") -> DataFrame:
    """LOG-8: join start and end records, duration in milliseconds."""
    return (starts.join(ends, id_col, "left")
                  .withColumn("duration_ms", boundary_diff("millisecond", "start_time", "end_time")))


def run_history(runs: DataFrame) -> DataFrame:
    """LOG-10: runs with duration in seconds, newest first."""
    return (runs.withColumn("duration_seconds", boundary_diff("second", "start_time", "end_time"))
                .orderBy(F.col("start_time").desc(), F.col("run_id").desc()))


def counts_summary(items: dict[str, DataFrame], distinct_on: dict[str, str] | None = None) -> DataFrame:
    """LOG-9: one row per object with a row count (or a distinct count)."""
    parts = []
    for name, df in items.items():
        c = (distinct_on or {}).get(name)
        agg = F.countDistinct(c) if c else F.count(F.lit(1))
        parts.append(df.agg(agg.alias("object_count")).select(F.lit(name).alias("object_type"), "object_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def log_rows(df: DataFrame, level, source, message, detail_cols: list[str], ts_col: str | None = None) -> DataFrame:
    """LOG-11: normalised log rows with the details as a JSON object."""
    lvl = F.upper(F.col(level) if isinstance(level, str) and level in df.columns else F.lit(level))
    src = F.col(source) if isinstance(source, str) and source in df.columns else F.lit(source)
    msg = F.col(message) if isinstance(message, str) and message in df.columns else F.lit(message)
    ts = F.col(ts_col) if ts_col else F.current_timestamp().cast("timestamp_ntz")
    return df.select(ts.alias("log_timestamp"),
                     F.when(lvl.isin("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), lvl)
                      .otherwise(F.lit("INFO")).alias("log_level"),
                     src.alias("log_source"), msg.alias("log_message"),
                     F.to_json(F.struct(*[F.col(c) for c in detail_cols])).alias("details"))
