"""Registered log-analytics plans (LOG-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.operators import logs as lg
from claimlake.plans import bindings as b
from claimlake.plans.registry import register

AS_OF = b.EVENTS_AS_OF
QUEUE_AS_OF = "2001-08-02 00:00:00"


@register("recent_application_logs", views=("v_log",), oracle=f"""
select * from v_log where log_timestamp >= timestamp '{AS_OF}' - interval 7 day and log_timestamp <= timestamp '{AS_OF}'
 and log_level = 'WARNING' order by log_timestamp desc, log_id desc limit 100""")
def recent_application_logs(spark, d):
    return lg.recent_logs(b.logs(spark, d), AS_OF, 7, n=100, id_col="log_id", log_level="WARNING")


@register("recent_errors", views=("v_error",), oracle=f"""
select * from v_error where error_timestamp >= timestamp '{AS_OF}' - interval 7 day
 and error_timestamp <= timestamp '{AS_OF}' and resolved = false
order by error_timestamp desc, error_id desc limit 100""")
def recent_errors(spark, d):
    return lg.recent_logs(b.errors(spark, d), AS_OF, 7, ts_col="error_timestamp", n=100, id_col="error_id",
                          resolved=False)


@register("slow_requests", views=("v_api",), oracle=f"""
select * from v_api where log_timestamp >= timestamp '{AS_OF}' - interval 7 day and log_timestamp <= timestamp '{AS_OF}'
 and path like '/api/c%' and latency_ms >= 1000 order by log_timestamp desc, request_id desc limit 100""")
def slow_requests(spark, d):
    return lg.recent_logs(b.api_requests(spark, d), AS_OF, 7, n=100, id_col="request_id",
                          like={"path": "/api/c%"}, min_values={"latency_ms": 1000})


@register("file_processing_log", views=("v_file_log",), oracle=f"""
select * from v_file_log where log_timestamp >= timestamp '{QUEUE_AS_OF}' - interval 30 day
 and log_timestamp <= timestamp '{QUEUE_AS_OF}' and file_name like 'asia/%' and stage like 'PROC%'
order by log_timestamp desc, file_name desc limit 100""")
def file_processing_log(spark, d):
    return lg.recent_logs(b.file_log(spark, d), QUEUE_AS_OF, 30, n=100, id_col="file_name",
                          like={"file_name": "asia/%", "stage": "PROC%"})


@register("file_processing_summary", views=("v_file_log",), oracle=f"""
select file_name, tpa, count(*) as total_stages, count(*) filter (where status = 'SUCCESS') as stages_ok,
 count(*) filter (where status = 'FAILED') as stages_failed, max(log_timestamp) as last_activity,
 cast(sum(rows_processed) as bigint) as rows_processed, cast(sum(rows_failed) as bigint) as rows_failed
from v_file_log where log_timestamp >= timestamp '{QUEUE_AS_OF}' - interval 7 day and log_timestamp <= timestamp '{QUEUE_AS_OF}'
group by file_name, tpa order by last_activity desc, file_name, tpa""")
def file_processing_summary(spark, d):
    return lg.file_summary(b.file_log(spark, d), QUEUE_AS_OF)


@register("log_stats", views=("v_log", "v_task", "v_error"), oracle=f"""
select 'application' as log_type, count(*) as total, count(*) filter (where log_level = 'ERROR') as errors,
 count(*) filter (where log_level = 'WARNING') as warnings from v_log
 where log_timestamp >= timestamp '{AS_OF}' - interval 7 day and log_timestamp <= timestamp '{AS_OF}'
union all
select 'task', count(*), count(*) filter (where status = 'FAILED'), count(*) filter (where status = 'PROCESSING') from v_task
 where start_time >= timestamp '{AS_OF}' - interval 7 day and start_time <= timestamp '{AS_OF}'
union all
select 'error', count(*), count(*) filter (where not resolved), count(*) filter (where resolved) from v_error
 where error_timestamp >= timestamp '{AS_OF}' - interval 7 day and error_timestamp <= timestamp '{AS_OF}'""")
def log_stats(spark, d):
    return lg.log_stats(b.logs(spark, d), b.task_runs(spark, d), b.errors(spark, d), AS_OF, 7)


@register("task_durations", views=("v_task",), oracle="""
select s.run_id, s.task_name, s.start_time, s.status, e.end_time,
 cast(epoch_ms(e.end_time) - epoch_ms(s.start_time) as bigint) as duration_ms
from (select run_id, task_name, start_time, status from v_task) s
left join (select run_id, end_time from v_task where end_time is not null) e on s.run_id = e.run_id""")
def task_durations(spark, d):
    t = b.task_runs(spark, d)
    starts = t.select("run_id", "task_name", "start_time", "status")
    ends = t.filter(F.col("end_time").isNotNull()).select("run_id", "end_time")
    return lg.close_runs(starts, ends)


@register("run_history", views=("v_task",), oracle="""
select *, cast(date_diff('second', start_time, end_time) as bigint) as duration_seconds from v_task""")
def run_history(spark, d):
    return lg.run_history(b.task_runs(spark, d))


@register("silver_summary", views=("v_claim", "v_member", "v_provider", "v_tpa", "v_raw"), oracle="""
select 'claims' as object_type, count(*) as object_count from v_claim
union all select 'members', count(*) from v_member
union all select 'providers', count(*) from v_provider
union all select 'tenants', count(distinct tpa_code) from v_tpa
union all select 'files', count(distinct file_name) from v_raw""")
def silver_summary(spark, d):
    return lg.counts_summary({"claims": b.claims(spark, d), "members": b.members(spark, d),
                              "providers": b.providers(spark, d), "tenants": b.tpa_master(spark, d),
                              "files": b.raw_rows(spark, d, with_ids=False).select("file_name")},
                             {"tenants": "tpa_code", "files": "file_name"})


@register("recent_task_executions", views=("v_task",), oracle=f"""
select * from v_task where start_time >= timestamp '{QUEUE_AS_OF}' - interval 7 day and start_time <= timestamp '{QUEUE_AS_OF}'
 and status = 'FAILED' order by start_time desc, run_id desc limit 100""")
def recent_task_executions(spark, d):
    """LOG-2: task executions of the last 7 days, one status, newest first."""
    return lg.recent_logs(b.task_runs(spark, d), QUEUE_AS_OF, 7, ts_col="start_time", n=100, id_col="run_id",
                          status="FAILED")
