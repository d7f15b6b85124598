"""Gold rule engine: entity registry, rule catalogue, rule-driven aggregation,
calculation rules, quality checks, business metrics and gold reports.

Rule and metric catalogues are metadata (tens of rows); their texts are
compiled into one ``groupBy().agg()`` / one projection per gold table, never
one scan per rule.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions.dates import as_ts
from claimlake.functions.dialect import to_spark_sql
from claimlake.operators.merge import merge_upsert

# Fixed values of the reference catalogues.
TRANSFORMATION_RULES = [
    # (rule_name, rule_type, tpa, source_table, target_table, rule_logic, priority, execution_order)
    ("AGGREGATE_CLAIMS_BY_PERIOD_PROVIDER", "AGGREGATION", "ALL", "SILVER.CLAIMS_*", "CLAIMS_ANALYTICS_ALL",
     "GROUP BY YEAR(service_date), MONTH(service_date), claim_type, provider_id", 100, 1),
    ("CALCULATE_DISCOUNT_RATE", "CALCULATION", "ALL", "CLAIMS_ANALYTICS_ALL", "CLAIMS_ANALYTICS_ALL",
     "(total_billed_amount - total_paid_amount) / NULLIF(total_billed_amount, 0)", 100, 2),
    ("CALCULATE_AVG_PER_CLAIM", "CALCULATION", "ALL", "CLAIMS_ANALYTICS_ALL", "CLAIMS_ANALYTICS_ALL",
     "total_billed_amount / NULLIF(claim_count, 0), total_paid_amount / NULLIF(claim_count, 0)", 100, 3),
    ("AGGREGATE_MEMBER_CLAIMS", "AGGREGATION", "ALL", "SILVER.CLAIMS_*", "MEMBER_360_ALL",
     "GROUP BY member_id, COUNT(*), SUM(paid_amount)", 100, 1),
    ("CALCULATE_MEMBER_AGE", "CALCULATION", "ALL", "MEMBER_360_ALL", "MEMBER_360_ALL",
     "DATEDIFF(YEAR, date_of_birth, CURRENT_DATE())", 100, 2),
    ("CALCULATE_RISK_SCORE", "CALCULATION", "ALL", "MEMBER_360_ALL", "MEMBER_360_ALL",
     "CASE WHEN total_paid > 50000 THEN 5 WHEN total_paid > 25000 THEN 4 WHEN total_paid > 10000 THEN 3 "
     "WHEN total_paid > 5000 THEN 2 ELSE 1 END", 100, 3),
    ("AGGREGATE_PROVIDER_METRICS", "AGGREGATION", "ALL", "SILVER.CLAIMS_*", "PROVIDER_PERFORMANCE_ALL",
     "GROUP BY provider_id, measurement_period", 100, 1),
    ("CALCULATE_PROVIDER_EFFICIENCY", "CALCULATION", "ALL", "PROVIDER_PERFORMANCE_ALL", "PROVIDER_PERFORMANCE_ALL",
     "total_paid / NULLIF(unique_members, 0), total_paid / NULLIF(total_claims, 0)", 100, 2),
    ("AGGREGATE_FINANCIAL_METRICS", "AGGREGATION", "ALL", "SILVER.CLAIMS_*", "FINANCIAL_SUMMARY_ALL",
     "GROUP BY fiscal_year, fiscal_month, claim_type", 100, 1),
    ("CALCULATE_PMPM", "CALCULATION", "ALL", "FINANCIAL_SUMMARY_ALL", "FINANCIAL_SUMMARY_ALL",
     "total_paid / NULLIF(member_count, 0)", 100, 2),
    ("CALCULATE_MLR", "CALCULATION", "ALL", "FINANCIAL_SUMMARY_ALL", "FINANCIAL_SUMMARY_ALL",
     "total_paid / NULLIF(total_billed, 0)", 100, 3),
]
QUALITY_RULES = [
    # (rule_name, rule_type, table_name, tpa, field_name, check_logic, threshold_value, threshold_operator,
    #  severity, action_on_failure)
    ("CHECK_NEGATIVE_AMOUNTS", "VALIDITY", "CLAIMS_ANALYTICS_ALL", "ALL", "total_paid_amount",
     "total_paid_amount >= 0", 0, ">=", "ERROR", "REJECT"),
    ("CHECK_REQUIRED_FIELDS", "COMPLETENESS", "CLAIMS_ANALYTICS_ALL", "ALL", None,
     "claim_year IS NOT NULL AND claim_month IS NOT NULL AND claim_type IS NOT NULL", 100, "=", "CRITICAL", "REJECT"),
    ("CHECK_DISCOUNT_RATE", "VALIDITY", "CLAIMS_ANALYTICS_ALL", "ALL", "discount_rate",
     "discount_rate BETWEEN 0 AND 1", 1, "<=", "WARNING", "FLAG"),
    ("CHECK_MEMBER_COUNT", "CONSISTENCY", "MEMBER_360_ALL", "ALL", "total_claims",
     "total_claims = medical_claims + dental_claims + pharmacy_claims", 100, "=", "ERROR", "FLAG"),
    ("CHECK_DATA_FRESHNESS", "TIMELINESS", "CLAIMS_ANALYTICS_ALL", "ALL", None,
     "DATEDIFF(DAY, MAX(updated_at), CURRENT_TIMESTAMP()) <= 1", 1, "<=", "WARNING", "ALERT"),
]
BUSINESS_METRICS = [
    # (metric_name, metric_category, tpa, calculation_logic)
    ("TOTAL_HEALTHCARE_SPEND", "FINANCIAL", "ALL", "SUM(total_paid) FROM FINANCIAL_SUMMARY_ALL"),
    ("AVG_COST_PER_MEMBER", "FINANCIAL", "ALL", "SUM(total_paid) / COUNT(DISTINCT member_id) FROM MEMBER_360_ALL"),
    ("MEMBER_ENGAGEMENT_RATE", "OPERATIONAL", "ALL",
     "COUNT(DISTINCT CASE WHEN total_claims > 0 THEN member_id END) / COUNT(DISTINCT member_id) FROM MEMBER_360_ALL"),
    ("PROVIDER_NETWORK_EFFICIENCY", "OPERATIONAL", "ALL", "AVG(discount_rate) FROM PROVIDER_PERFORMANCE_ALL"),
    ("HIGH_RISK_MEMBER_COUNT", "CLINICAL", "ALL", "COUNT(*) FROM MEMBER_360_ALL WHERE risk_score >= 4"),
]
# Names used by rule texts for the gold columns (rules and DDL disagree).
SYNONYMS = {"total_paid_amount": "total_paid", "total_billed_amount": "total_billed"}
SEVERITY_RANK = {"CRITICAL": 4, "ERROR": 3, "WARNING": 2, "INFO": 1}


def catalog_df(spark: SparkSession, kind: str) -> DataFrame:
    if kind == "transformation":
        return spark.createDataFrame(TRANSFORMATION_RULES, "rule_name string, rule_type string, tpa string, "
                                     "source_table string, target_table string, rule_logic string, priority int, "
                                     "execution_order int").withColumn("is_active", F.lit(True))
    if kind == "quality":
        rows = [r[:6] + (float(r[6]),) + r[7:] for r in QUALITY_RULES]
        return spark.createDataFrame(rows, "rule_name string, rule_type string, table_name string, tpa string, "
                                     "field_name string, check_logic string, threshold_value double, "
                                     "threshold_operator string, severity string, action_on_failure string") \
                    .withColumn("is_active", F.lit(True))
    if kind == "metrics":
        return spark.createDataFrame(BUSINESS_METRICS, "metric_name string, metric_category string, tpa string, "
                                     "calculation_logic string").withColumn("is_active", F.lit(True))
    raise ValueError(kind)


def with_synonyms(df: DataFrame) -> DataFrame:
    add = {k: F.col(v) for k, v in SYNONYMS.items() if v in df.columns and k not in df.columns}
    return df.withColumns(add) if add else df


# -- registry ------------------------------------------------------------------

def register_entity(schemas: DataFrame, fields: DataFrame, new_schema: DataFrame, new_fields: DataFrame):
    """GLD-1: upsert the entity on (table_name, tpa); replace its field list."""
    s = merge_upsert(schemas, new_schema, ["table_name", "tpa"])
    keys = new_fields.select("table_name", "tpa").distinct()
    f = fields.join(keys, ["table_name", "tpa"], "left_anti").unionByName(new_fields, allowMissingColumns=True)
    return s, f


def rules_for(rules: DataFrame, tpa: str) -> DataFrame:
    """GLD-13: active rules of a tenant or ALL, by execution order then priority."""
    return (rules.filter(F.col("tpa").isin(tpa, "ALL") & F.coalesce(F.col("is_active"), F.lit(True)))
                 .orderBy(F.col("execution_order"), F.col("priority"), F.col("rule_name")))


def set_rule_active(rules: DataFrame, names: DataFrame, flag: bool, key: str = "rule_name") -> DataFrame:
    n = names.select(key).distinct().withColumn("_hit", F.lit(True))
    j = rules.join(n, key, "left")
    return j.withColumn("is_active", F.when(F.col("_hit"), F.lit(flag)).otherwise(F.col("is_active"))).drop("_hit")


def quality_rules_for(rules: DataFrame, tpa: str | None = None) -> DataFrame:
    """GLD-25: by severity (text order, descending), then name."""
    r = rules if tpa is None else rules.filter(F.col("tpa").isin(tpa, "ALL"))
    return r.orderBy(F.col("severity").desc(), F.col("rule_name"))


# -- rule-driven aggregation and calculations -------------------------------------------

def run_gold_mappings(src: DataFrame, mappings: DataFrame, target_table: str, order_col: str = "service_date",
                      as_of=None) -> DataFrame:
    """GLD-14: compile gold field mappings into one grouped aggregate.

    Each mapping gives (target_field, source_field or transformation_logic,
    aggregation_function, group_by_fields, filter_condition).  A filter becomes
    a conditional aggregate; FIRST/LAST pick by ``order_col``.
    """
    rows = [r.asDict() for r in mappings.filter((F.col("target_table") == target_table)
                                                & F.coalesce(F.col("is_active"), F.lit(True))).collect()]
    if not rows:
        raise ValueError(f"no mappings for {target_table}")
    lists = {tuple(g.strip() for g in (r["group_by_fields"] or "").split(",") if g.strip()) for r in rows}
    if len(lists) > 1:
        raise ValueError(f"mappings of {target_table} group by different lists: {sorted(lists)}")
    groups = list(next(iter(lists)))
    aggs = []
    for r in sorted(rows, key=lambda r: (r.get("priority") or 0, r["target_field"])):
        logic = r.get("transformation_logic") or r["source_field"]
        x = F.expr(to_spark_sql(logic, as_of))
        if r.get("filter_condition"):
            x = F.when(F.expr(to_spark_sql(r["filter_condition"], as_of)), x)
        fn = (r.get("aggregation_function") or "").upper()
        if fn == "SUM":
            a = F.sum(x)
        elif fn == "AVG":
            a = F.sum(x).cast("double") / F.count(x).cast("double")
        elif fn == "COUNT":
            a = F.count(x)
        elif fn == "COUNT_DISTINCT":
            a = F.countDistinct(x)
        elif fn == "MIN":
            a = F.min(x)
        elif fn == "MAX":
            a = F.max(x)
        elif fn == "FIRST":
            a = F.min_by(x, F.when(x.isNotNull(), F.struct(F.col(order_col), F.col(r["source_field"]))))
        elif fn == "LAST":
            a = F.max_by(x, F.when(x.isNotNull(), F.struct(F.col(order_col), F.col(r["source_field"]))))
        else:
            raise ValueError(f"unknown aggregation {fn}")
        aggs.append(a.alias(r["target_field"]))
    return src.groupBy(*groups).agg(*aggs)


def _split_top(text: str) -> list[str]:
    out, depth, cur, q = [], 0, [], None
    for ch in text:
        if q:
            cur.append(ch)
            q = None if ch == q else q
            continue
        if ch in "'\"":
            q = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def _as_double_refs(text: str, cols: list[str]) -> str:
    for c in sorted(cols, key=len, reverse=True):
        text = re.sub(rf"(?<![\w'.]){re.escape(c)}(?![\w'(])", f"CAST({c} AS DOUBLE)", text, flags=re.IGNORECASE)
    return text


def apply_calculations(df: DataFrame, rules: DataFrame, target_table: str, as_of=None) -> tuple[DataFrame, DataFrame]:
    """GLD-15: CALCULATION rules of a table as derived columns, in execution order.

    A rule text may hold several comma-separated expressions (columns
    ``<rule>_1``, ``<rule>_2``...).  A rule whose text does not resolve is
    reported FAILED and skipped.  Returns (frame, rule status).
    """
    spark = df.sparkSession
    rs = [r.asDict() for r in rules.filter((F.col("target_table") == target_table)
                                           & (F.upper("rule_type") == "CALCULATION")
                                           & F.coalesce(F.col("is_active"), F.lit(True))).collect()]
    out = with_synonyms(df)
    status = []
    for r in sorted(rs, key=lambda r: (r.get("execution_order") or 0, r.get("priority") or 0, r["rule_name"])):
        # Decimal / decimal keeps only a few fraction digits at high precision;
        # ratios are computed in double, the money columns stay decimal.
        dec = [f.name for f in out.schema.fields if f.dataType.typeName() == "decimal"]
        parts = [_as_double_refs(p, dec) for p in _split_top(r["rule_logic"])]
        names = [r["rule_name"].lower()] if len(parts) == 1 else [f"{r['rule_name'].lower()}_{i + 1}"
                                                                   for i in range(len(parts))]
        try:
            cols = {n: F.expr(to_spark_sql(p, as_of)) for n, p in zip(names, parts)}
            trial = out.withColumns(cols)
            trial.schema
            out = trial
            status.append((r["rule_name"], "SUCCESS", None))
        except AnalysisException as e:
            status.append((r["rule_name"], "FAILED", str(e).split("\n")[0][:500]))
    return out, spark.createDataFrame(status, "rule_name string, status string, error string")


# -- quality checks ------------------------------------------------------------------

def _meets(value: Column, op: str, threshold: float) -> Column:
    return {">": value > threshold, "<": value < threshold, ">=": value >= threshold, "<=": value <= threshold,
            "=": value == threshold, "!=": value != threshold}[op]


def _has_aggregate(df: DataFrame, text: str) -> bool:
    try:
        df.select(F.expr(text), F.col(df.columns[0])).schema
        return False
    except AnalysisException:
        df.select(F.expr(text)).schema  # raises if the text is broken, not only aggregate
        return True


def run_quality_rules(tables: dict[str, DataFrame], rules: DataFrame, run_id: str, as_of,
                      tenant_col: str = "tpa") -> DataFrame:
    """GLD-16..21: evaluate active quality rules, one aggregate per table and tenant scope (ALL: all rows).

    Row rules count passing rows (NULL counts as failed) with ``count_if``;
    aggregate rules (e.g. freshness) are one predicate over the table.  The
    required pass rate is the threshold when it is a percentage (> 1), else
    100 %, compared with the rule's operator when it is a percentage.
    Status: PASSED, else FAILED for CRITICAL/ERROR and WARNING otherwise;
    ERROR when the rule text does not resolve.
    """
    spark = next(iter(tables.values())).sparkSession
    rs = [r.asDict() for r in rules.filter(F.coalesce(F.col("is_active"), F.lit(True))).collect()]
    parts = []
    broken = []
    scopes = sorted({(r["table_name"], r.get("tpa") or "ALL") for r in rs if r["table_name"] in tables})
    for tname, tenant in scopes:
        # a tenant's rule sees that tenant's rows
        df = tables[tname]
        d = with_synonyms(df if tenant == "ALL" or tenant_col not in df.columns else df.filter(F.col(tenant_col) == tenant))
        mine = [r for r in rs if r["table_name"] == tname and (r.get("tpa") or "ALL") == tenant]
        aggs = [F.count(F.lit(1)).alias("_n")]
        meta = []
        for i, r in enumerate(mine):
            text = to_spark_sql(r["check_logic"], as_of)
            try:
                is_agg = _has_aggregate(d, text)
            except AnalysisException as e:
                broken.append((r, str(e).split("\n")[0][:500]))
                continue
            if is_agg:
                aggs.append(F.coalesce(F.expr(text).cast("boolean"), F.lit(False)).alias(f"_ok{i}"))
            else:
                aggs.append(F.count_if(F.coalesce(F.expr(text).cast("boolean"), F.lit(False))).alias(f"_ok{i}"))
            meta.append((i, r, is_agg))
        if not meta:
            continue
        g = d.agg(*aggs)
        rows = []
        for i, r, is_agg in meta:
            checked = F.lit(1).cast("bigint") if is_agg else F.col("_n")
            passed = F.col(f"_ok{i}").cast("int").cast("bigint") if is_agg else F.col(f"_ok{i}")
            rows.append(F.struct(F.lit(r["rule_name"]).alias("rule_name"), F.lit(tname).alias("table_name"),
                                 F.lit(r["tpa"]).alias("tpa"), checked.alias("records_checked"),
                                 passed.alias("records_passed"), F.lit(r["threshold_value"]).cast("double")
                                 .alias("threshold_value"), F.lit(r["threshold_operator"]).alias("op"),
                                 F.lit(r["severity"]).alias("severity")))
        parts.append(g.select(F.inline(F.array(*rows))))
    res = None
    for p in parts:
        res = p if res is None else res.unionByName(p)
    if res is None:
        res = spark.createDataFrame([], "rule_name string, table_name string, tpa string, records_checked long, "
                                        "records_passed long, threshold_value double, op string, severity string")
    rate = F.when(F.col("records_checked") > 0, F.col("records_passed").cast("double") * 100
                  / F.col("records_checked").cast("double"))
    res = res.withColumn("records_failed", F.col("records_checked") - F.col("records_passed")) \
             .withColumn("pass_rate", rate)
    th = F.col("threshold_value")
    pct = th > 1
    meets = (F.when(pct & (F.col("op") == ">"), F.col("pass_rate") > th)
              .when(pct & (F.col("op") == "<"), F.col("pass_rate") < th)
              .when(pct & (F.col("op") == ">="), F.col("pass_rate") >= th)
              .when(pct & (F.col("op") == "<="), F.col("pass_rate") <= th)
              .when(pct & (F.col("op") == "!="), F.col("pass_rate") != th)
              .when(pct, F.col("pass_rate") == th)
              .otherwise(F.col("pass_rate") == 100))
    res = res.withColumn("status", F.when(F.coalesce(meets, F.lit(False)), "PASSED")
                         .when(F.col("severity").isin("CRITICAL", "ERROR"), "FAILED").otherwise("WARNING"))
    if broken:
        b = spark.createDataFrame([(r["rule_name"], r["table_name"], r["tpa"], float(r["threshold_value"] or 0),
                                    r["threshold_operator"], r["severity"], why) for r, why in broken],
                                  "rule_name string, table_name string, tpa string, threshold_value double, op string, "
                                  "severity string, details string")
        b = b.withColumns({"records_checked": F.lit(0).cast("bigint"), "records_passed": F.lit(0).cast("bigint"),
                           "records_failed": F.lit(0).cast("bigint"), "pass_rate": F.lit(None).cast("double"),
                           "status": F.lit("ERROR")})
        res = res.withColumn("details", F.lit(None).cast("string")).unionByName(b)
    else:
        res = res.withColumn("details", F.lit(None).cast("string"))
    return res.select(F.lit(run_id).alias("run_id"), "rule_name", "table_name", "tpa", "records_checked",
                      "records_passed", "records_failed", "pass_rate", "threshold_value", "status", "details",
                      as_ts(as_of).alias("check_timestamp"))


def quality_summary(rules: DataFrame, results: DataFrame) -> DataFrame:
    """GLD-22: active rules with result counts by status and last check.

    As in the reference, ``total_checks`` is COUNT(*) of the left join, so a
    rule that never ran reports 1.
    """
    r = rules.filter(F.coalesce(F.col("is_active"), F.lit(True))).select("rule_name", "table_name", "severity")
    j = r.join(results.select("rule_name", "table_name", "status", "check_timestamp"), ["rule_name", "table_name"],
               "left")
    st = F.col("status")
    return j.groupBy("rule_name", "table_name", "severity").agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(st == "PASSED").alias("passed_checks"),
        F.count_if(st == "FAILED").alias("failed_checks"), F.count_if(st == "WARNING").alias("warning_checks"),
        F.max("check_timestamp").alias("last_check"))


def quality_stats(results: DataFrame, tpa: str | None = None) -> DataFrame:
    """GLD-23: totals and pass rate (NULL when there are no results)."""
    r = results if tpa is None else results.filter(F.col("tpa").isin(tpa, "ALL"))
    st = F.col("status")
    n = F.count(F.lit(1))
    return r.agg(n.alias("total_checks"), F.count_if(st == "PASSED").alias("passed"),
                 F.count_if(st == "FAILED").alias("failed"), F.count_if(st == "WARNING").alias("warnings"),
                 F.when(n > 0, F.count_if(st == "PASSED").cast("double") * 100 / n.cast("double"))
                  .alias("pass_rate"))


def quality_results(results: DataFrame, rules: DataFrame, tpa: str | None = None, n: int = 100) -> DataFrame:
    """GLD-24: newest results with rule name, severity, logic and action (one join)."""
    r = results if tpa is None else results.filter(F.col("tpa").isin(tpa, "ALL"))
    meta = rules.select("rule_name", "table_name", F.col("severity").alias("rule_severity"), "check_logic",
                        "action_on_failure")
    return (r.join(meta, ["rule_name", "table_name"], "left")
             .orderBy(F.col("check_timestamp").desc(), "rule_name", "table_name").limit(n))


# -- business metrics ------------------------------------------------------------------

_METRIC = re.compile(r"^\s*(?P<expr>.+?)\s+FROM\s+(?P<table>[A-Za-z_][\w]*)\s*(?:WHERE\s+(?P<where>.+))?$",
                     re.IGNORECASE | re.DOTALL)


_AGG_CALL = re.compile(r"\b(SUM|COUNT|MIN|MAX|AVG)\s*\(", re.IGNORECASE)
# aggregates that take no filter clause here: a metric with one and a condition scans on its own
_OTHER_AGG = re.compile(r"\b(STD\w*|VAR\w*|MEDIAN|MODE|PERCENTILE\w*|APPROX\w*|ANY_VALUE|CORR|COVAR\w*|COUNT_IF|BOOL_\w+|EVERY|SOME|ANY|FIRST\w*|LAST\w*|M(?:AX|IN)_BY)\s*\(",
                        re.IGNORECASE)


def _double_aggregates(text: str, where: str | None = None) -> str:
    """Wrap SUM/COUNT/MIN/MAX calls in CAST(... AS DOUBLE): the aggregate
    itself stays exact (decimal sums), the ratio between aggregates is a
    double division instead of a precision-capped decimal one."""
    from claimlake.functions.dialect import _close
    out, i = [], 0
    while True:
        m = _AGG_CALL.search(text, i)
        if not m:
            out.append(text[i:])
            return "".join(out)
        end = _close(text, m.end())
        out.append(text[i:m.start()])
        only = f" FILTER (WHERE {where})" if where else ""
        out.append(f"CAST({text[m.start():m.end()]}{text[m.end():end]}){only} AS DOUBLE)")
        i = end + 1


def evaluate_metrics(spark: SparkSession, metrics: DataFrame, views: dict[str, DataFrame], as_of=None,
                     tpa: str | None = None) -> DataFrame:
    """GLD-26..31: evaluate ``expr FROM table [WHERE cond]`` per active metric.

    Only the tables in ``views`` may be named (a whitelist).  A metric of a
    tenant sees that tenant's rows.  All metrics of a table are one aggregate:
    conditions are filters of its calls.  A text that names another table or
    does not resolve gives a NULL value; the other metrics stay.
    """
    ms = [m.asDict() for m in metrics.filter(F.coalesce(F.col("is_active"), F.lit(True))).collect()]
    tables = {k.upper(): v for k, v in views.items()}
    row = lambda m, value: F.struct(F.lit(m["metric_name"]).alias("metric_name"), F.lit(m["metric_category"]).alias("metric_category"),
                                    value.cast("double").alias("metric_value"))
    found: dict[str | None, list] = {}
    parts = []
    for m in sorted(ms, key=lambda m: m["metric_name"]):
        if tpa is not None and m["tpa"] not in (tpa, "ALL"):
            continue
        p = _METRIC.match(m["calculation_logic"])
        name = p.group("table").upper() if p else None
        if name not in tables:
            found.setdefault(None, []).append((m, None))
            continue
        src, only = tables[name], []
        if p.group("where"):
            only.append(f"({to_spark_sql(p.group('where'), as_of)})")
        if m["tpa"] not in (None, "ALL") and "tpa" in src.columns:
            only.append("tpa = '" + m["tpa"].replace("'", "\\'") + "'")
        text, where = to_spark_sql(p.group("expr"), as_of), " AND ".join(only) or None
        try:
            if where and _OTHER_AGG.search(text):
                alone = src.filter(where).agg(F.expr(_double_aggregates(text)).alias("_m"))
                alone.schema  # analysis only
                parts.append(alone.select(F.inline(F.array(row(m, F.col("_m"))))))
                continue
            text = _double_aggregates(text, where)
            src.agg(F.expr(text)).schema  # analysis only
            found.setdefault(name, []).append((m, text))
        except (AnalysisException, ParseException):
            found.setdefault(None, []).append((m, None))
    for name, items in found.items():
        if name is None:
            parts.append(spark.range(1).select(F.inline(F.array(*[row(m, F.lit(None)) for m, _ in items]))))
            continue
        g = tables[name].agg(*[F.expr(t).cast("double").alias(f"_m{i}") for i, (_, t) in enumerate(items)])
        parts.append(g.select(F.inline(F.array(*[row(m, F.col(f"_m{i}")) for i, (m, _) in enumerate(items)]))))
    if not parts:
        return spark.createDataFrame([], "metric_name string, metric_category string, metric_value double")
    return reduce(DataFrame.unionByName, parts)


def metric_catalog(metrics: DataFrame, tpa: str | None = None) -> DataFrame:
    """GLD-32: metric counts per category, active and inactive."""
    m = metrics if tpa is None else metrics.filter(F.col("tpa").isin(tpa, "ALL"))
    act = F.coalesce(F.col("is_active"), F.lit(True))
    return m.groupBy("metric_category").agg(F.count(F.lit(1)).alias("metrics"),
                                            F.count_if(act).alias("active_metrics"),
                                            F.count_if(~act).alias("inactive_metrics"))


# -- gold reports ----------------------------------------------------------------------

def gold_page(df: DataFrame, order: list, tpa: str | None = None, n: int = 100) -> DataFrame:
    """GLD-33: newest n rows of an entity, one tenant or ALL."""
    d = df if tpa in (None, "ALL") else df.filter(F.col("tpa") == tpa)
    return d.orderBy(*order).limit(n)


def gold_stats(df: DataFrame, ts_col: str | None = None) -> DataFrame:
    """GLD-34: rows, last update, status."""
    n = F.count(F.lit(1))
    last = F.max(ts_col) if ts_col else F.lit(None).cast("timestamp_ntz")
    return df.agg(n.alias("row_count"), last.alias("last_updated"),
                  F.when(n > 0, "ACTIVE").otherwise("EMPTY").alias("status"))


def gold_processing_summary(log: DataFrame) -> DataFrame:
    """GLD-35: runs of the all-tenant tables (names ending in ``_ALL``; the
    underscore is escaped so it is not a wildcard)."""
    l = log.filter(F.col("table_name").like("%\\_ALL"))
    return l.groupBy("table_name", "tpa", "processing_type", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("records_processed").cast("bigint").alias("records_processed"),
        (F.sum("duration_seconds").cast("double") / F.count("duration_seconds").cast("double"))
         .alias("avg_duration_seconds"),
        F.max("end_time").alias("last_run"))
