"""Registered data-quality plans (DQ-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.operators import quality as q
from claimlake.plans import bindings as b
from claimlake.plans.registry import register

# Silver claims per table: target table from the claim type, one DQ batch per
# service year, measured at the end of that year.
SILVER_SQL = """
select tpa, concat(claim_type, '_CLAIMS') as target_table, cast(received_date as timestamp) as _load_timestamp,
 concat('DQ_', cast(year(service_date) as varchar), '1231_235959') as batch_id,
 cast(concat(cast(year(service_date) as varchar), '-12-31 23:59:59') as timestamp) as measured_timestamp,
 claim_id, member_id, provider_id, service_date, billed_amount, paid_amount
from v_claim"""


def silver_claims(spark, d, claim_rows=None):
    c = b.claims(spark, d) if claim_rows is None else claim_rows
    y = F.year("service_date").cast("string")
    return c.select("tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("target_table"),
                    F.col("received_date").cast("timestamp_ntz").alias("_load_timestamp"),
                    F.concat(F.lit("DQ_"), y, F.lit("1231_235959")).alias("batch_id"),
                    F.to_timestamp_ntz(F.concat(y, F.lit("-12-31 23:59:59"))).alias("measured_timestamp"),
                    "claim_id", "member_id", "provider_id", "service_date", "billed_amount", "paid_amount")


def metrics(spark, d, claim_rows=None):
    s = silver_claims(spark, d, claim_rows)
    return q.dq_metrics(s, ["tpa", "target_table", "batch_id"], "_load_timestamp",
                        F.col("measured_timestamp"), F.col("batch_id"))


METRICS_SQL = f"""
with s as ({SILVER_SQL}),
g as (select tpa, target_table, batch_id, count(*) as n, max(measured_timestamp) as now, max(_load_timestamp) as last
      from s group by 1, 2, 3),
h as (select *, cast(date_diff('hour', last, now) as double) as hours from g),
p as (select *, n > 0 as rok, hours <= 24.0 as hok,
        (cast(n > 0 as int) + cast(coalesce(hours <= 24.0, false) as int)) as np from h),
metrics as (
 select batch_id, tpa, target_table, 'ROW_COUNT' as metric_name, cast(n as double) as metric_value,
  0.0::double as metric_threshold, rok as passed, 'Total number of rows in table' as description, now as measured_timestamp from p
 union all
 select batch_id, tpa, target_table, 'DATA_FRESHNESS_HOURS', hours, 24.0::double, hok, 'Hours since last data load', now from p
 union all
 select batch_id, tpa, target_table, 'OVERALL_QUALITY_SCORE', cast(np as double) / 2.0 * 100, 80.0::double,
  cast(np as double) / 2.0 * 100 >= 80.0, concat('Overall data quality score: ', np, ' of 2 checks passed'), now from p)"""


@register("dq_metrics", views=("v_claim",), oracle=METRICS_SQL + "\nselect * from metrics")
def dq_metrics(spark, d):
    return metrics(spark, d)


@register("dq_all_tables", views=("v_claim",), oracle=f"""
with s as ({SILVER_SQL}),
g as (select tpa, target_table, count(*) as n, max(_load_timestamp) as last from s group by 1, 2),
h as (select *, cast(date_diff('hour', last, timestamp '2001-12-31 00:00:00') as double) as hours from g),
p as (select *, (cast(n > 0 as int) + cast(coalesce(hours <= 24.0, false) as int)) as np from h)
select 'DQ_20011231_000000' as batch_id, tpa, target_table, 'ROW_COUNT' as metric_name, cast(n as double) as metric_value,
 0.0::double as metric_threshold, n > 0 as passed, 'Total number of rows in table' as description,
 timestamp '2001-12-31 00:00:00' as measured_timestamp from p
union all
select 'DQ_20011231_000000', tpa, target_table, 'DATA_FRESHNESS_HOURS', hours, 24.0::double, hours <= 24.0,
 'Hours since last data load', timestamp '2001-12-31 00:00:00' from p
union all
select 'DQ_20011231_000000', tpa, target_table, 'OVERALL_QUALITY_SCORE', cast(np as double) / 2.0 * 100, 80.0::double,
 cast(np as double) / 2.0 * 100 >= 80.0, concat('Overall data quality score: ', np, ' of 2 checks passed'),
 timestamp '2001-12-31 00:00:00' from p""")
def dq_all_tables(spark, d):
    s = silver_claims(spark, d)
    return q.dq_metrics(s, ["tpa", "target_table"], "_load_timestamp", "2001-12-31 00:00:00", "DQ_20011231_000000")


@register("data_quality_summary", views=("v_claim",), oracle=METRICS_SQL + """,
lb as (select tpa, target_table, arg_max(batch_id, measured_timestamp) as batch_id from metrics group by 1, 2)
select m.tpa, m.target_table, m.batch_id,
 max(case when metric_name = 'OVERALL_QUALITY_SCORE' then metric_value end) as quality_score,
 max(case when metric_name = 'ROW_COUNT' then metric_value end) as row_count,
 max(case when metric_name = 'DATA_FRESHNESS_HOURS' then metric_value end) as hours_since_load,
 count(*) filter (where passed) as checks_passed, count(*) as total_checks,
 max(measured_timestamp) as last_check_timestamp
from metrics m join lb on m.tpa = lb.tpa and m.target_table = lb.target_table and m.batch_id = lb.batch_id
group by 1, 2, 3""")
def data_quality_summary(spark, d):
    return q.dq_summary(metrics(spark, d))


@register("data_quality_failures", views=("v_claim",), oracle=METRICS_SQL + """
select * from metrics where passed = false and target_table like '%DENTAL%'
order by measured_timestamp desc, tpa, target_table, metric_name, batch_id limit 100""")
def data_quality_failures(spark, d):
    return q.dq_failures(metrics(spark, d), None, "%DENTAL%", 100)


@register("data_quality_trends", views=("v_claim",), oracle=METRICS_SQL + """
select tpa, target_table, batch_id, metric_value as quality_score, measured_timestamp,
 lag(metric_value) over w as previous_score, metric_value - lag(metric_value) over w as score_change
from metrics where metric_name = 'OVERALL_QUALITY_SCORE'
window w as (partition by tpa, target_table order by measured_timestamp, batch_id)""")
def data_quality_trends(spark, d):
    return q.dq_trends(metrics(spark, d))


@register("quality_metrics_latest", views=("v_claim",), oracle=METRICS_SQL + """
select * from metrics where tpa = 'asia' and target_table = 'MEDICAL_CLAIMS'
 and batch_id = (select arg_max(batch_id, measured_timestamp) from metrics where tpa = 'asia' and target_table = 'MEDICAL_CLAIMS')""")
def quality_metrics_latest(spark, d):
    return q.dq_batch(metrics(spark, d), "asia", "MEDICAL_CLAIMS")


@register("dq_profile", views=("v_claim",), oracle="""
with g as (select count(*) as n,
  count(*) filter (where claim_id is null) as n_claim_id, count(*) filter (where member_id is null) as n_member_id,
  count(*) filter (where service_date is null) as n_service_date, count(*) filter (where paid_amount is null) as n_paid,
  count(*) filter (where paid_amount < 0 or paid_amount > 50000) as r_paid,
  count(*) filter (where service_date > date '2001-06-30') as d_service
 from v_claim)
select 'NULL_COUNT' as check_name, 'claim_id' as column_name, cast(n_claim_id as double) as value from g
union all select 'COMPLETENESS_PCT', 'claim_id', case when n > 0 then cast(n - n_claim_id as double) * 100 / cast(n as double) end from g
union all select 'NULL_COUNT', 'member_id', cast(n_member_id as double) from g
union all select 'COMPLETENESS_PCT', 'member_id', case when n > 0 then cast(n - n_member_id as double) * 100 / cast(n as double) end from g
union all select 'NULL_COUNT', 'service_date', cast(n_service_date as double) from g
union all select 'COMPLETENESS_PCT', 'service_date', case when n > 0 then cast(n - n_service_date as double) * 100 / cast(n as double) end from g
union all select 'NULL_COUNT', 'paid_amount', cast(n_paid as double) from g
union all select 'COMPLETENESS_PCT', 'paid_amount', case when n > 0 then cast(n - n_paid as double) * 100 / cast(n as double) end from g
union all select 'OUT_OF_RANGE', 'paid_amount', cast(r_paid as double) from g
union all select 'FUTURE_DATE', 'service_date', cast(d_service as double) from g
union all select 'ROW_COUNT', '*', cast(n as double) from g
union all select 'DUPLICATE_KEYS', 'order_key', cast(coalesce(sum(k - 1), 0) as double)
 from (select order_key, count(*) as k from v_claim group by order_key having count(*) > 1)""")
def dq_profile(spark, d):
    return q.dq_profile(b.claims(spark, d), ["order_key"], {"paid_amount": (0, 50000)},
                        {"service_date": "2001-06-30"},
                        ["claim_id", "member_id", "service_date", "paid_amount"])
