"""Silver data-quality metrics, summaries, trends and profiling.

All tables (and tenants) are measured in one grouped pass; metric rows are
produced by unpivoting the aggregate with ``stack``, not by one query per
metric or per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.functions.dates import as_ts, boundary_diff

ROW_COUNT = "ROW_COUNT"
FRESHNESS = "DATA_FRESHNESS_HOURS"
SCORE = "OVERALL_QUALITY_SCORE"
METRIC_COLS = ["batch_id", "tpa", "target_table", "metric_name", "metric_value", "metric_threshold", "passed",
               "description", "measured_timestamp"]


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def dq_metrics(df: DataFrame, keys: list[str], load_ts: str | None, as_of, batch_id,
               freshness_hours: float = 24.0, min_score: float = 80.0) -> DataFrame:
    """DQ-1..4: ROW_COUNT, DATA_FRESHNESS_HOURS and OVERALL_QUALITY_SCORE per group.

    ``keys`` must include ``tpa`` and ``target_table``; ``as_of``/``batch_id``
    may be literals or per-row columns constant within a group.  A NULL
    ``passed`` counts as not passed in the score.
    """
    now = as_ts(as_of) if not isinstance(as_of, Column) else as_of
    aggs = [F.count(F.lit(1)).alias("_rows"), F.max(now).alias("_now"), F.max(_c(batch_id)).alias("_batch")]
    if load_ts:
        aggs.append(F.max(load_ts).alias("_last"))
    g = df.groupBy(*keys).agg(*aggs)
    rows_ok = F.col("_rows") > 0
    if load_ts:
        hours = boundary_diff("hour", "_last", "_now").cast("double")
        fresh_ok = hours <= freshness_hours
        n_pass = rows_ok.cast("int") + F.coalesce(fresh_ok, F.lit(False)).cast("int")
        n_total = F.lit(2)
    else:
        hours, fresh_ok = F.lit(None).cast("double"), F.lit(None).cast("boolean")
        n_pass, n_total = rows_ok.cast("int"), F.lit(1)
    g = g.select(*keys, "_batch", "_now", F.col("_rows").cast("double").alias("_rv"), rows_ok.alias("_rok"),
                 hours.alias("_hv"), fresh_ok.alias("_hok"),
                 (n_pass.cast("double") / n_total.cast("double") * 100).alias("_sv"),
                 n_pass.alias("_np"), n_total.alias("_nt"))
    # The description texts of stored metrics.
    score_text = F.concat(F.lit("Overall data quality score: "), F.col("_np").cast("string"), F.lit(" of "),
                          F.col("_nt").cast("string"), F.lit(" checks passed"))
    entries = [
        (F.lit(ROW_COUNT), F.col("_rv"), F.lit(0.0), F.col("_rok"), F.lit("Total number of rows in table")),
        (F.lit(SCORE), F.col("_sv"), F.lit(min_score), F.col("_sv") >= min_score, score_text),
    ]
    if load_ts:
        entries.insert(1, (F.lit(FRESHNESS), F.col("_hv"), F.lit(float(freshness_hours)), F.col("_hok"),
                           F.lit("Hours since last data load")))
    arr = F.array(*[F.struct(n.alias("metric_name"), v.alias("metric_value"), t.alias("metric_threshold"),
                             p.alias("passed"), d.alias("description")) for n, v, t, p, d in entries])
    other = [k for k in keys if k not in ("tpa", "target_table", "batch_id")]
    return (g.select("tpa", "target_table", *other, F.col("_batch").alias("batch_id"),
                     F.col("_now").alias("measured_timestamp"), F.inline(arr))
             .select(*METRIC_COLS, *other))


def _latest_batch(metrics: DataFrame) -> DataFrame:
    """Latest batch per (tpa, table): by measurement time, then batch id (not the text max)."""
    return metrics.groupBy("tpa", "target_table").agg(
        F.max_by("batch_id", F.struct("measured_timestamp", "batch_id")).alias("batch_id"))


def dq_summary(metrics: DataFrame) -> DataFrame:
    """DQ-5: one row per table for its latest batch (pivot of the metrics)."""
    m = metrics.join(_latest_batch(metrics), ["tpa", "target_table", "batch_id"], "left_semi")
    name = F.col("metric_name")
    return m.groupBy("tpa", "target_table", "batch_id").agg(
        F.max(F.when(name == SCORE, F.col("metric_value"))).alias("quality_score"),
        F.max(F.when(name == ROW_COUNT, F.col("metric_value"))).alias("row_count"),
        F.max(F.when(name == FRESHNESS, F.col("metric_value"))).alias("hours_since_load"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count(F.lit(1)).alias("total_checks"),
        F.max("measured_timestamp").alias("last_check_timestamp"))


def dq_failures(metrics: DataFrame, tpa: str | None = None, table_like: str | None = None, n: int = 100) -> DataFrame:
    """DQ-6: failed checks, newest first, top n."""
    m = metrics.filter(F.col("passed") == F.lit(False))
    if tpa is not None:
        m = m.filter(F.col("tpa") == tpa)
    if table_like is not None:
        m = m.filter(F.col("target_table").like(table_like))
    m = m.orderBy(F.col("measured_timestamp").desc(), "tpa", "target_table", "metric_name", "batch_id")
    return m.limit(n) if n else m


def dq_trends(metrics: DataFrame) -> DataFrame:
    """DQ-7: overall score with the previous score and the change."""
    w = Window.partitionBy("tpa", "target_table").orderBy("measured_timestamp", "batch_id")
    s = metrics.filter(F.col("metric_name") == SCORE)
    prev = F.lag("metric_value").over(w)
    return s.select("tpa", "target_table", "batch_id", F.col("metric_value").alias("quality_score"),
                    "measured_timestamp", prev.alias("previous_score"),
                    (F.col("metric_value") - prev).alias("score_change"))


def dq_batch(metrics: DataFrame, tpa: str, table: str, batch_id: str | None = None) -> DataFrame:
    """DQ-8: metrics of one batch of one table; default its latest batch."""
    m = metrics.filter((F.col("tpa") == tpa) & (F.col("target_table") == table))
    if batch_id is not None:
        return m.filter(F.col("batch_id") == batch_id)
    return m.join(_latest_batch(m), ["tpa", "target_table", "batch_id"], "left_semi")


def dq_profile(df: DataFrame, keys: list[str] | None = None, ranges: dict | None = None,
               dates: dict | None = None, columns: list[str] | None = None) -> DataFrame:
    """DQ-9: null count and completeness per column, duplicate keys, range and
    date violations -- one aggregate over the table, unpivoted to
    (check_name, column_name, value)."""
    cols = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_null_{c}"))
    for c, (lo, hi) in (ranges or {}).items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < lo)
        if hi is not None:
            cond = cond | (F.col(c) > hi)
        aggs.append(F.count_if(cond).alias(f"_range_{c}"))
    for c, limit in (dates or {}).items():
        aggs.append(F.count_if(F.col(c) > F.lit(limit).cast("date")).alias(f"_date_{c}"))
    g = df.agg(*aggs)
    entries = []
    for c in cols:
        entries.append((F.lit("NULL_COUNT"), F.lit(c), F.col(f"_null_{c}").cast("double")))
        entries.append((F.lit("COMPLETENESS_PCT"), F.lit(c),
                        F.when(F.col("_n") > 0, (F.col("_n") - F.col(f"_null_{c}")).cast("double") * 100
                               / F.col("_n").cast("double"))))
    for c in (ranges or {}):
        entries.append((F.lit("OUT_OF_RANGE"), F.lit(c), F.col(f"_range_{c}").cast("double")))
    for c in (dates or {}):
        entries.append((F.lit("FUTURE_DATE"), F.lit(c), F.col(f"_date_{c}").cast("double")))
    entries.append((F.lit("ROW_COUNT"), F.lit("*"), F.col("_n").cast("double")))
    arr = F.array(*[F.struct(a.alias("check_name"), b.alias("column_name"), v.alias("value")) for a, b, v in entries])
    out = g.select(F.inline(arr))
    if keys:
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > 1)
                 .agg(F.coalesce(F.sum(F.col("_k") - 1), F.lit(0)).cast("double").alias("value"))
                 .select(F.lit("DUPLICATE_KEYS").alias("check_name"), F.lit(",".join(keys)).alias("column_name"),
                         "value"))
        out = out.unionByName(dup)
    return out
