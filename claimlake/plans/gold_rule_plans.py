"""Registered gold rule-engine plans (GLD-13..35)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.functions.dates import as_ts
from claimlake.operators import gold
from claimlake.operators import gold_rules as gr
from claimlake.plans import bindings as b
from claimlake.plans.gold_plans import RISK_CUTS
from claimlake.plans.registry import ORACLES, register
from claimlake.session import written

AS_OF = "2001-12-31 00:00:00"
RUN_ID = "GQ_20011231"

# Gold field mappings for a provider-month entity (fixed test catalogue):
# (target_field, source_field, aggregation, filter)
PROVIDER_MONTHLY = [
    ("claim_count", "claim_id", "COUNT", None),
    ("total_paid", "paid_amount", "SUM", None),
    ("max_billed", "billed_amount", "MAX", None),
    ("avg_paid", "paid_amount", "AVG", None),
    ("dental_paid", "paid_amount", "SUM", "claim_type = 'DENTAL'"),
    ("first_service", "service_date", "FIRST", None),
    ("last_status", "claim_status", "LAST", None),
]


def _gold_mappings(spark):
    rows = [("SILVER", "CLAIMS", s, "PROVIDER_MONTHLY", t, "ALL", None, a, "tpa, provider_id", f, True, 100)
            for t, s, a, f in PROVIDER_MONTHLY]
    return spark.createDataFrame(rows, "source_schema string, source_table string, source_field string, "
                                       "target_table string, target_field string, tpa string, "
                                       "transformation_logic string, aggregation_function string, "
                                       "group_by_fields string, filter_condition string, is_active boolean, "
                                       "priority int")


@register("gold_mapping_agg", views=("v_claim",), oracle="""
select tpa, provider_id, count(claim_id) as claim_count, cast(sum(paid_amount) as decimal(28,2)) as total_paid,
 max(billed_amount) as max_billed, cast(sum(paid_amount) as double) / cast(count(paid_amount) as double) as avg_paid,
 cast(sum(case when claim_type = 'DENTAL' then paid_amount end) as decimal(28,2)) as dental_paid,
 min(service_date) as first_service,
 arg_max(claim_status, strftime(service_date, '%Y%m%d') || claim_status) as last_status
from v_claim group by tpa, provider_id""")
def gold_mapping_agg(spark, d):
    return gr.run_gold_mappings(b.claims(spark, d), _gold_mappings(spark), "PROVIDER_MONTHLY")


@register("gold_calculations", views=("v_claim",), oracle="""
with g as (select tpa, cast(year(service_date) as int) as claim_year, cast(month(service_date) as int) as claim_month,
             claim_type, provider_id, count(*) as claim_count,
             cast(sum(billed_amount) as decimal(28,2)) as total_billed, cast(sum(paid_amount) as decimal(28,2)) as total_paid
           from v_claim group by 1, 2, 3, 4, 5)
select tpa, claim_year, claim_month, claim_type, provider_id,
 (cast(total_billed as double) - cast(total_paid as double)) / nullif(cast(total_billed as double), 0) as calculate_discount_rate,
 cast(total_billed as double) / nullif(cast(claim_count as double), 0) as calculate_avg_per_claim_1,
 cast(total_paid as double) / nullif(cast(claim_count as double), 0) as calculate_avg_per_claim_2
from g""")
def gold_calculations(spark, d):
    ca = gold.claims_analytics(b.claims(spark, d))
    out, _status = gr.apply_calculations(ca, gr.catalog_df(spark, "transformation"), "CLAIMS_ANALYTICS_ALL", AS_OF)
    calc = ["calculate_discount_rate", "calculate_avg_per_claim_1", "calculate_avg_per_claim_2"]
    return out.select("tpa", "claim_year", "claim_month", "claim_type", "provider_id",
                      *[F.col(c).cast("double").alias(c) for c in calc])


def _gold_tables(spark, d):
    ca = gold.claims_analytics(b.claims(spark, d)).withColumn("updated_at", as_ts(AS_OF))
    m360 = gold.member_360(b.claims(spark, d), b.members(spark, d), None, b.CLAIMS_AS_OF, RISK_CUTS)
    return {"CLAIMS_ANALYTICS_ALL": ca, "MEMBER_360_ALL": m360}


def results(spark, d):
    return gr.run_quality_rules(_gold_tables(spark, d), gr.catalog_df(spark, "quality"), RUN_ID, AS_OF)


RESULTS_SQL = f"""
with ca as (select tpa, cast(year(service_date) as int) as claim_year, cast(month(service_date) as int) as claim_month,
             claim_type, provider_id, cast(sum(billed_amount) as decimal(28,2)) as total_billed,
             cast(sum(paid_amount) as decimal(28,2)) as total_paid
            from v_claim group by 1, 2, 3, 4, 5),
cad as (select *, cast(total_billed - total_paid as double) / nullif(cast(total_billed as double), 0) as discount_rate from ca),
m as (select member_id, count(*) as total_claims, count(*) filter (where claim_type = 'MEDICAL') as med,
        count(*) filter (where claim_type = 'DENTAL') as den, count(*) filter (where claim_type = 'PHARMACY') as pha
      from v_claim group by member_id),
m360 as (select coalesce(total_claims, 0) as total_claims, coalesce(med, 0) as med, coalesce(den, 0) as den,
           coalesce(pha, 0) as pha from v_member left join m using (member_id)),
raw as (
 select 'CHECK_NEGATIVE_AMOUNTS' as rule_name, 'CLAIMS_ANALYTICS_ALL' as table_name, count(*) as records_checked,
  count(*) filter (where coalesce(total_paid >= 0, false)) as records_passed, 0.0 as threshold_value, 'ERROR' as severity, '>=' as op from cad
 union all
 select 'CHECK_REQUIRED_FIELDS', 'CLAIMS_ANALYTICS_ALL', count(*),
  count(*) filter (where coalesce(claim_year is not null and claim_month is not null and claim_type is not null, false)), 100.0, 'CRITICAL', '=' from cad
 union all
 select 'CHECK_DISCOUNT_RATE', 'CLAIMS_ANALYTICS_ALL', count(*),
  count(*) filter (where coalesce(discount_rate between 0 and 1, false)), 1.0, 'WARNING', '<=' from cad
 union all
 select 'CHECK_DATA_FRESHNESS', 'CLAIMS_ANALYTICS_ALL', 1, 1, 1.0, 'WARNING', '<=' from cad having count(*) >= 0
 union all
 select 'CHECK_MEMBER_COUNT', 'MEMBER_360_ALL', count(*),
  count(*) filter (where coalesce(total_claims = med + den + pha, false)), 100.0, 'ERROR', '=' from m360),
r as (select *, records_checked - records_passed as records_failed,
        case when records_checked > 0 then cast(records_passed as double) * 100 / cast(records_checked as double) end as pass_rate
      from raw),
results as (
 select '{RUN_ID}' as run_id, rule_name, table_name, 'ALL' as tpa, cast(records_checked as bigint) as records_checked,
  cast(records_passed as bigint) as records_passed, cast(records_failed as bigint) as records_failed, pass_rate,
  cast(threshold_value as double) as threshold_value,
  case when (case when threshold_value > 1 then pass_rate = threshold_value else pass_rate = 100 end) then 'PASSED'
       when severity in ('CRITICAL', 'ERROR') then 'FAILED' else 'WARNING' end as status,
  cast(null as varchar) as details, timestamp '{AS_OF}' as check_timestamp
 from r)"""
QUALITY_SQL = "quality as (select * from (values " + ", ".join(
    "('{}', '{}', '{}', '{}', '{}', {})".format(r[0], r[2], r[8], r[5].replace("'", "''"), r[9], "true")
    for r in gr.QUALITY_RULES) + ") as t(rule_name, table_name, severity, check_logic, action_on_failure, is_active))"


@register("quality_check_results", views=("v_claim", "v_member"), oracle=RESULTS_SQL + "\nselect * from results")
def quality_check_results(spark, d):
    return results(spark, d)


@register("quality_check_summary", views=("v_claim", "v_member"), oracle=RESULTS_SQL + f""",
{QUALITY_SQL}
select q.rule_name, q.table_name, q.severity, count(*) as total_checks,
 count(*) filter (where status = 'PASSED') as passed_checks, count(*) filter (where status = 'FAILED') as failed_checks,
 count(*) filter (where status = 'WARNING') as warning_checks, max(check_timestamp) as last_check
from quality q left join results r on q.rule_name = r.rule_name and q.table_name = r.table_name
group by 1, 2, 3""")
def quality_check_summary(spark, d):
    return gr.quality_summary(gr.catalog_df(spark, "quality"), results(spark, d))


@register("quality_stats", views=("v_claim", "v_member"), oracle=RESULTS_SQL + """
select count(*) as total_checks, count(*) filter (where status = 'PASSED') as passed,
 count(*) filter (where status = 'FAILED') as failed, count(*) filter (where status = 'WARNING') as warnings,
 case when count(*) > 0 then cast(count(*) filter (where status = 'PASSED') as double) * 100 / cast(count(*) as double) end as pass_rate
from results""")
def quality_stats(spark, d):
    return gr.quality_stats(results(spark, d))


@register("quality_results", views=("v_claim", "v_member"), oracle=RESULTS_SQL + f""",
{QUALITY_SQL}
select r.*, q.severity as rule_severity, q.check_logic, q.action_on_failure
from results r left join quality q on r.rule_name = q.rule_name and r.table_name = q.table_name
order by check_timestamp desc, r.rule_name, r.table_name limit 100""")
def quality_results(spark, d):
    return gr.quality_results(results(spark, d), gr.catalog_df(spark, "quality"), None, 100)


def _metric_views(spark, d):
    # three views read the claims: joined once, written, and read by each
    c = written(b.claims(spark, d).select("tpa", "member_id", "provider_id", "claim_type", "service_date", "diagnosis_code",
                                          "billed_amount", "allowed_amount", "paid_amount"), "metric-claims")
    return {"FINANCIAL_SUMMARY_ALL": gold.financial_summary(c),
            "MEMBER_360_ALL": gold.member_360(c, b.members(spark, d), None, b.CLAIMS_AS_OF, RISK_CUTS),
            "PROVIDER_PERFORMANCE_ALL": gold.provider_performance(c, None, None)}


METRICS_SQL = f"""
with fs as ({ORACLES['financial_summary']}),
m360 as ({ORACLES['member_360']}),
pp as (select cast(sum(paid_amount) as decimal(28,2)) as total_paid, cast(sum(billed_amount) as decimal(28,2)) as total_billed
       from v_claim group by tpa, provider_id, concat(year(service_date), '-Q', quarter(service_date))),
vals as (
 select 'AVG_COST_PER_MEMBER' as metric_name, 'FINANCIAL' as metric_category,
   cast(sum(total_paid) as double) / cast(count(distinct member_id) as double) as metric_value from m360
 union all select 'HIGH_RISK_MEMBER_COUNT', 'CLINICAL', cast(count(*) as double) from m360 where risk_score >= 4
 union all select 'MEMBER_ENGAGEMENT_RATE', 'OPERATIONAL',
   cast(count(distinct case when total_claims > 0 then member_id end) as double) / cast(count(distinct member_id) as double) from m360
 union all select 'PROVIDER_NETWORK_EFFICIENCY', 'OPERATIONAL',
   avg(cast(total_billed - total_paid as double) / nullif(cast(total_billed as double), 0)) from pp
 union all select 'TOTAL_HEALTHCARE_SPEND', 'FINANCIAL', cast(sum(total_paid) as double) from fs)"""


@register("business_metrics", views=("v_claim", "v_member", "v_provider"), oracle=METRICS_SQL + "\nselect * from vals")
def business_metrics(spark, d):
    return gr.evaluate_metrics(spark, gr.catalog_df(spark, "metrics"), _metric_views(spark, d), b.CLAIMS_AS_OF)


@register("metric_catalog", views=("v_claim", "v_member", "v_provider"), oracle=METRICS_SQL + """
select metric_category, count(*) as metrics, count(*) as active_metrics, 0 as inactive_metrics,
 sum(metric_value) as category_value_total
from vals group by metric_category""")
def metric_catalog(spark, d):
    cat = gr.metric_catalog(gr.catalog_df(spark, "metrics"))
    vals = gr.evaluate_metrics(spark, gr.catalog_df(spark, "metrics"), _metric_views(spark, d), b.CLAIMS_AS_OF)
    tot = vals.groupBy("metric_category").agg(F.sum("metric_value").alias("category_value_total"))
    return cat.join(tot, "metric_category", "left")


@register("gold_page", views=("v_claim", "v_provider"), oracle=f"""
select * from ({ORACLES['claims_analytics']}) where tpa = 'asia'
order by claim_year desc, claim_month desc, claim_type, provider_id limit 100""")
def gold_page(spark, d):
    ca = gold.claims_analytics(b.claims(spark, d), b.providers(spark, d))
    order = [F.col("claim_year").desc(), F.col("claim_month").desc(), F.col("claim_type"), F.col("provider_id")]
    return gr.gold_page(ca, order, "asia", 100)


@register("gold_stats", views=("v_claim", "v_provider"), oracle=f"""
select count(*) as row_count, timestamp '{AS_OF}' as last_updated, case when count(*) > 0 then 'ACTIVE' else 'EMPTY' end as status
from ({ORACLES['claims_analytics']})""")
def gold_stats(spark, d):
    ca = gold.claims_analytics(b.claims(spark, d)).withColumn("updated_at", as_ts(AS_OF))
    return gr.gold_stats(ca, "updated_at")


@register("gold_rules", views=("v_claim", "v_member", "v_provider"), oracle=f"""
with rules as (select * from (values {", ".join("('{}', '{}', '{}', {}, {})".format(r[0], r[1], r[4], r[6], r[7]) for r in gr.TRANSFORMATION_RULES)})
               as t(rule_name, rule_type, target_table, priority, execution_order)),
counts as (
 select 'CLAIMS_ANALYTICS_ALL' as target_table, count(*) as target_rows from ({ORACLES['claims_analytics']})
 union all select 'MEMBER_360_ALL', count(*) from v_member
 union all select 'PROVIDER_PERFORMANCE_ALL', count(*) from (select 1 from v_claim group by tpa, provider_id,
   concat(year(service_date), '-Q', quarter(service_date)))
 union all select 'FINANCIAL_SUMMARY_ALL', count(*) from ({ORACLES['financial_summary']}))
select r.rule_name, r.rule_type, r.target_table, r.priority, r.execution_order, c.target_rows
from rules r left join counts c on r.target_table = c.target_table""")
def gold_rules(spark, d):
    rules = gr.rules_for(gr.catalog_df(spark, "transformation"), "asia")
    c = b.claims(spark, d)
    tables = {"CLAIMS_ANALYTICS_ALL": gold.claims_analytics(c),
              "MEMBER_360_ALL": b.members(spark, d),
              "PROVIDER_PERFORMANCE_ALL": gold.provider_performance(c, None, None),
              "FINANCIAL_SUMMARY_ALL": gold.financial_summary(c)}
    counts = None
    for name, df in tables.items():
        part = gr.gold_stats(df).select(F.lit(name).alias("target_table"), F.col("row_count").alias("target_rows"))
        counts = part if counts is None else counts.unionByName(part)
    return rules.select("rule_name", "rule_type", "target_table", "priority", "execution_order") \
                .join(counts, "target_table", "left")


@register("gold_processing_summary", views=("v_task",), oracle="""
with log as (select case status when 'SUCCESS' then 'CLAIMS_ANALYTICS_ALL' when 'FAILED' then 'MEMBER_360_ALL'
                      else concat('CLAIMS_', upper(split_part(task_name, '_', 2)), 'XALL') end as table_name,
               split_part(task_name, '_', 2) as tpa, 'AGGREGATION' as processing_type, status,
               run_id as records_processed, date_diff('second', start_time, end_time) as duration_seconds, end_time
             from v_task)
select table_name, tpa, processing_type, status, count(*) as runs, cast(sum(records_processed) as bigint) as records_processed,
 cast(sum(duration_seconds) as double) / cast(count(duration_seconds) as double) as avg_duration_seconds,
 max(end_time) as last_run
from log where table_name like '%\\_ALL' escape '\\' group by 1, 2, 3, 4""")
def gold_processing_summary(spark, d):
    from claimlake.functions.dates import boundary_diff
    t = b.task_runs(spark, d)
    st = F.col("status")
    log = t.select(
        F.when(st == "SUCCESS", "CLAIMS_ANALYTICS_ALL").when(st == "FAILED", "MEMBER_360_ALL")
         .otherwise(F.concat(F.lit("CLAIMS_"), F.upper(F.split_part("task_name", F.lit("_"), F.lit(2))), F.lit("XALL")))
         .alias("table_name"),
        F.split_part("task_name", F.lit("_"), F.lit(2)).alias("tpa"), F.lit("AGGREGATION").alias("processing_type"),
        "status", F.col("run_id").alias("records_processed"),
        boundary_diff("second", "start_time", "end_time").alias("duration_seconds"), F.col("end_time"))
    return gr.gold_processing_summary(log)


@register("gold_field_counts", views=("v_defs",), oracle="""
select table_name, 'ALL' as tpa, 'observed' as description, count(*) as fields, count(*) filter (where nullable = 'Y') as nullable_fields
from v_defs group by table_name""")
def gold_field_counts(spark, d):
    """GLD-1: the observed tables registered over an older, shorter registry of one of them; fields per registered table."""
    defs = b.target_schemas(spark, d).select("table_name", F.lit("ALL").alias("tpa"), F.col("column_name").alias("field_name"), "data_type", "nullable")
    old = defs.filter("table_name = 'MEDICAL_CLAIMS' and field_name like '%AMOUNT'").withColumn("field_name", F.concat("field_name", F.lit("_OLD")))
    entity = defs.select("table_name", "tpa").distinct()
    schemas, fields = gr.register_entity(entity.filter("table_name = 'MEDICAL_CLAIMS'").withColumn("description", F.lit("old")), old,
                                         entity.withColumn("description", F.lit("observed")), defs)
    return schemas.join(fields, ["table_name", "tpa"]).groupBy("table_name", "tpa", "description").agg(
        F.count(F.lit(1)).alias("fields"), F.count_if(F.col("nullable") == "Y").alias("nullable_fields"))
