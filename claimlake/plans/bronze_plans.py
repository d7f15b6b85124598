"""Registered bronze plans (BRZ-*) over the driver bindings."""

from __future__ import annotations

import datetime as _dt
import functools
import uuid

from pyspark.sql import functions as F

from claimlake.operators import bronze as br
from claimlake.operators.store import TableSet
from claimlake.plans import bindings as b
from claimlake.plans.registry import register
from claimlake.session import checkpoint_dir
from claimlake.sources.tables import table

QUEUE_AS_OF = _dt.datetime(2001, 8, 2, 0, 0, 0)
KNOWN_BEFORE = _dt.datetime(1998, 1, 1)

Q_COLS = ("queue_id, file_name, tpa, file_size_bytes, status, discovered_timestamp, processed_timestamp, "
          "retry_count, file_type")


def ft_sql(c: str) -> str:
    return (f"case when upper({c}) like '%.CSV%' then 'CSV' when upper({c}) like '%.XLSX' or upper({c}) like '%.XLS' "
            f"then 'EXCEL' else 'UNKNOWN' end")


@register("discover_files", views=("v_listing", "v_queue"), oracle=f"""
select l.file_name, split_part(l.file_name, '/', 1) as tpa, {ft_sql('l.file_name')} as file_type,
 l.size as file_size_bytes, 'PENDING' as status
from v_listing l
where not exists (select 1 from v_queue q where q.discovered_timestamp < timestamp '{KNOWN_BEFORE}' and q.file_name = l.file_name)""")
def discover_files(spark, d):
    known = b.queue(spark, d).filter(F.col("discovered_timestamp") < F.lit(KNOWN_BEFORE))
    return br.discover_files(b.listing(spark, d), known)


@register("file_type_counts", views=("v_queue",), oracle=f"""
select {ft_sql('file_name')} as file_type, count(*) as files from v_queue group by 1""")
def file_type_counts(spark, d):
    return br.file_type_counts(b.queue(spark, d))


@register("next_batch", views=("v_queue",), oracle=f"""
select {Q_COLS} from v_queue where status = 'PENDING' order by discovered_timestamp, queue_id limit 10""")
def next_batch(spark, d):
    return br.next_batch(b.queue(spark, d), 10)


@register("ingest_rows", views=("v_raw",), oracle="""
select record_id, file_name, file_row_number, tpa, file_type, load_timestamp, loaded_by,
 json_extract_string(raw_data, '$.CLAIM_ID') as claim_id, json_extract_string(raw_data, '$.PAID_AMOUNT') as paid_amount
from v_raw""")
def ingest_rows(spark, d):
    r = b.raw_rows(spark, d)
    return r.select("record_id", "file_name", "file_row_number", "tpa", "file_type", "load_timestamp", "loaded_by",
                    F.get_json_object("raw_data", "$.CLAIM_ID").alias("claim_id"),
                    F.get_json_object("raw_data", "$.PAID_AMOUNT").alias("paid_amount"))


@register("already_loaded", views=("v_queue", "v_raw"), oracle="""
select q.queue_id, q.file_name, q.tpa, coalesce(r.n, 0) as loaded_rows, r.n is not null as already_loaded
from v_queue q left join (select tpa, file_name, count(*) as n from v_raw group by 1, 2) r
  on q.tpa = r.tpa and q.file_name = r.file_name
where q.status in ('PENDING', 'PROCESSING')""")
def already_loaded(spark, d):
    batch = b.queue(spark, d).filter(F.col("status").isin("PENDING", "PROCESSING"))
    raw = b.raw_rows(spark, d, with_ids=False).select("tpa", "file_name")
    return br.skip_loaded(batch, raw).select("queue_id", "file_name", "tpa", "loaded_rows", "already_loaded")


@register("merge_raw", views=("v_raw",), oracle=f"""
select record_id, file_name, file_row_number, tpa from v_raw""")
def merge_raw(spark, d):
    raw = b.raw_rows(spark, d).select("record_id", "file_name", "file_row_number", "tpa", "load_timestamp")
    old = raw.filter(F.col("load_timestamp") < F.lit(KNOWN_BEFORE))
    return br.merge_raw(old, raw).select("record_id", "file_name", "file_row_number", "tpa")


RESULT_SQL = ("case queue_id % 3 when 0 then 'SUCCESS: loaded' when 1 then 'SKIPPED: already loaded' "
              "else 'ERROR: bad header' end")


@register("queue_transition", views=("v_queue",), oracle=f"""
with r as (select queue_id, {RESULT_SQL} as result from v_queue where status = 'PROCESSING')
select q.queue_id, q.file_name, q.tpa, q.file_size_bytes,
 case when r.result is null then q.status when r.result like 'SUCCESS%' then 'SUCCESS'
      when r.result like 'SKIPPED%' then 'SKIPPED' else 'FAILED' end as status,
 q.discovered_timestamp,
 case when r.result is null then q.processed_timestamp else timestamp '{QUEUE_AS_OF}' end as processed_timestamp,
 case when r.result like 'ERROR%' then q.retry_count + 1 else q.retry_count end as retry_count,
 q.file_type,
 case when r.result is not null and r.result not like 'SUCCESS%' then r.result end as error_message,
 r.result as process_result
from v_queue q left join r on q.queue_id = r.queue_id""")
def queue_transition(spark, d):
    q = b.queue(spark, d)
    k = F.col("queue_id")
    res = (q.filter(F.col("status") == "PROCESSING")
            .select("queue_id", F.when(k % 3 == 0, "SUCCESS: loaded").when(k % 3 == 1, "SKIPPED: already loaded")
                    .otherwise("ERROR: bad header").alias("result")))
    return br.apply_results(q, res, QUEUE_AS_OF)


@register("file_disposition", views=("v_queue",), oracle="""
(select queue_id, file_name, tpa, 'COMPLETED' as target_stage from v_queue where status = 'SUCCESS'
 order by processed_timestamp, queue_id limit 100)
union all
(select queue_id, file_name, tpa, 'ERROR' as target_stage from v_queue where status = 'FAILED' and retry_count >= 3
 order by processed_timestamp, queue_id limit 100)""")
def file_disposition(spark, d):
    return br.file_disposition(b.queue(spark, d), 100)


@register("retention_plan", views=("v_listing",), oracle=f"""
select *, case when stage in ('COMPLETED','ERROR') and age_days > 30 then 'ARCHIVE'
               when stage = 'ARCHIVE' and age_days > 90 then 'PURGE' end as action
from (select *, cast(date_diff('day', cast(modification_time as date), date '{QUEUE_AS_OF.date()}') as bigint) as age_days
      from v_listing)
where (stage in ('COMPLETED','ERROR') and age_days > 30) or (stage = 'ARCHIVE' and age_days > 90)""")
def retention_plan(spark, d):
    return br.retention_plan(b.listing(spark, d), QUEUE_AS_OF, 30, 90)


@register("delete_file", views=("v_queue", "v_raw"), oracle=f"""
with f as (select distinct tpa, file_name from v_queue where status = 'FAILED'),
c as (select r.tpa, r.file_name, count(*) as n from v_raw r join f on r.tpa = f.tpa and r.file_name = f.file_name group by 1, 2)
select q.queue_id, q.file_name, q.tpa, q.file_size_bytes,
 case when f.file_name is not null then 'DELETED' else q.status end as status,
 q.discovered_timestamp, q.processed_timestamp, q.retry_count, q.file_type,
 case when f.file_name is not null then coalesce(c.n, 0) end as deleted_rows
from v_queue q left join f on q.tpa = f.tpa and q.file_name = f.file_name
left join c on q.tpa = c.tpa and q.file_name = c.file_name""")
def delete_file(spark, d):
    q = b.queue(spark, d)
    files = q.filter(F.col("status") == "FAILED").select("tpa", "file_name")
    _, q2 = br.delete_files(b.raw_rows(spark, d, with_ids=False).select("tpa", "file_name"), q, files)
    return q2


@register("reset_stuck", views=("v_queue",), oracle=f"""
select queue_id, file_name, tpa, file_size_bytes,
 case when status = 'PROCESSING' and (processed_timestamp is null
        or processed_timestamp < timestamp '{QUEUE_AS_OF}' - interval 5 minute) then 'PENDING' else status end as status,
 discovered_timestamp, processed_timestamp, retry_count, file_type
from v_queue""")
def reset_stuck(spark, d):
    return br.reset_stuck(b.queue(spark, d), QUEUE_AS_OF)


@register("reprocess", views=("v_queue",), oracle="""
select queue_id, file_name, tpa, file_size_bytes,
 case when hit then 'PENDING' else status end as status, discovered_timestamp,
 case when hit then null else processed_timestamp end as processed_timestamp, retry_count, file_type
from (select *, status = 'FAILED' and retry_count >= 3 as hit from v_queue)""")
def reprocess(spark, d):
    q = b.queue(spark, d)
    ids = q.filter((F.col("status") == "FAILED") & (F.col("retry_count") >= 3)).select("queue_id")
    return br.reprocess(q, ids)


@register("unqueue", views=("v_queue",), oracle=f"""
select queue_id, file_name, tpa, file_size_bytes, case when tpa = 'asia' then 'DELETED' else status end as status,
 discovered_timestamp, processed_timestamp, retry_count, file_type
from v_queue where not (tpa = 'asia' and status in ('PENDING', 'FAILED'))""")
def unqueue(spark, d):
    q = b.queue(spark, d)
    return br.unqueue(q, q.filter(F.col("tpa") == "asia").select("file_name"))


@register("processing_status_summary", views=("v_queue",), oracle="""
select status, tpa, count(*) as file_count, cast(sum(file_size_bytes) as bigint) as total_bytes,
 min(discovered_timestamp) as oldest_file, max(discovered_timestamp) as newest_file
from v_queue group by status, tpa""")
def processing_status_summary(spark, d):
    return br.status_summary(b.queue(spark, d))


@register("recent_activity", views=("v_queue",), oracle=f"""
select queue_id, file_name, tpa, status, discovered_timestamp, processed_timestamp,
 cast(date_diff('second', discovered_timestamp, coalesce(processed_timestamp, timestamp '{QUEUE_AS_OF}')) as bigint) as duration_seconds
from v_queue order by discovered_timestamp desc, queue_id desc limit 100""")
def recent_activity(spark, d):
    return br.recent_activity(b.queue(spark, d), QUEUE_AS_OF, 100)


@register("failed_files", views=("v_queue",), oracle="""
select queue_id, file_name, tpa, retry_count, processed_timestamp from v_queue where status = 'FAILED'""")
def failed_files(spark, d):
    return br.failed_files(b.queue(spark, d))


@register("raw_data_statistics", views=("v_raw",), oracle="""
select tpa, file_type, count(*) as row_count, count(distinct file_name) as file_count,
 min(load_timestamp) as first_load, max(load_timestamp) as last_load
from v_raw group by tpa, file_type""")
def raw_data_statistics(spark, d):
    return br.raw_statistics(b.raw_rows(spark, d, with_ids=False))


@register("bronze_stats", views=("v_raw",), oracle="""
select count(*) as total_rows, count(distinct file_name) as total_files, count(distinct tpa) as total_tpas,
 min(load_timestamp) as earliest_load, max(load_timestamp) as latest_load from v_raw""")
def bronze_stats(spark, d):
    return br.bronze_stats(b.raw_rows(spark, d, with_ids=False))


@register("raw_browse", views=("v_raw",), oracle="""
select record_id, file_name, file_row_number, tpa, file_type, load_timestamp from v_raw where tpa = 'asia'
order by file_row_number, record_id limit 100""")
def raw_browse(spark, d):
    r = b.raw_rows(spark, d).select("record_id", "file_name", "file_row_number", "tpa", "file_type", "load_timestamp")
    return br.raw_browse(r, "asia", None, 100)


@register("queue_list", views=("v_queue",), oracle=f"""
select {Q_COLS} from v_queue where tpa = 'europe' order by discovered_timestamp desc, queue_id desc limit 100""")
def queue_list(spark, d):
    return br.queue_list(b.queue(spark, d), "europe", 100)


@register("source_fields", views=("v_raw",), oracle="""
select distinct tpa, unnest(json_keys(raw_data)) as field_name from v_raw""")
def source_fields(spark, d):
    return br.source_fields(b.raw_rows(spark, d, with_ids=False).select("tpa", "raw_data"))


@register("source_profile", views=("v_raw",), oracle="""
select tpa, count(*) as flattened_records, count(distinct field_name) as distinct_fields
from (select tpa, unnest(json_keys(raw_data)) as field_name from v_raw) group by tpa""")
def source_profile(spark, d):
    return br.source_profile(b.raw_rows(spark, d, with_ids=False).select("tpa", "raw_data"))


@register("tpa_statistics", views=("v_tpa", "v_raw", "v_queue"), oracle="""
with r as (select tpa, count(*) as total_records, count(distinct file_name) as files_loaded,
             min(load_timestamp) as first_load, max(load_timestamp) as last_load from v_raw group by tpa),
q as (select tpa, count(*) as files_queued, count(*) filter (where status = 'SUCCESS') as files_success,
        count(*) filter (where status = 'FAILED') as files_failed, count(*) filter (where status = 'PENDING') as files_pending
      from v_queue group by tpa)
select t.tpa_code as tpa, t.tpa_name, t.active, coalesce(total_records, 0) as total_records,
 coalesce(files_loaded, 0) as files_loaded, first_load, last_load, coalesce(files_queued, 0) as files_queued,
 coalesce(files_success, 0) as files_success, coalesce(files_failed, 0) as files_failed,
 coalesce(files_pending, 0) as files_pending
from v_tpa t left join r on t.tpa_code = r.tpa left join q on t.tpa_code = q.tpa""")
def tpa_statistics(spark, d):
    return br.tpa_statistics(b.tpa_master(spark, d), b.raw_rows(spark, d, with_ids=False).select("tpa", "file_name", "load_timestamp"),
                             b.queue(spark, d))


def _tpa_changes(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    code = lambda c: F.lower(F.replace(F.col(c), F.lit(" "), F.lit("_")))
    return (n.select(code("n_name").alias("tpa_code"), F.col("n_name").alias("tpa_name"))
             .unionByName(r.select(code("r_name").alias("tpa_code"), F.col("r_name").alias("tpa_name"))))


@register("tpa_upsert", views=("v_tpa",), oracle="""
with ch as (select lower(replace(n_name,' ','_')) as tpa_code, n_name as tpa_name from nation
            union all select lower(replace(r_name,' ','_')), r_name from region)
select coalesce(t.tpa_code, ch.tpa_code) as tpa_code, coalesce(ch.tpa_name, t.tpa_name) as tpa_name,
 true as active, t.tpa_rank
from v_tpa t full outer join ch on t.tpa_code = ch.tpa_code""")
def tpa_upsert(spark, d):
    return br.upsert_tpa(b.tpa_master(spark, d), _tpa_changes(spark, d))


@register("tpa_set_active", views=("v_tpa",), oracle="""
select tpa_code, tpa_name, case when tpa_code in ('asia','europe','atlantis') then false else active end as active, tpa_rank
from v_tpa""")
def tpa_set_active(spark, d):
    codes = spark.createDataFrame([("asia",), ("europe",), ("atlantis",)], "tpa_code string")
    return br.set_tpa_active(b.tpa_master(spark, d), codes, False)[0]


@register("active_tpas", views=("v_tpa",), oracle="select * from v_tpa where active")
def active_tpas(spark, d):
    return br.active_tpas(b.tpa_master(spark, d))


@register("unregistered_rows", views=("v_queue", "v_tpa"), oracle=f"""
select {Q_COLS} from v_queue q where not exists (select 1 from v_tpa t where t.active and t.tpa_code = q.tpa)""")
def unregistered_rows(spark, d):
    return br.split_by_registered(b.queue(spark, d), b.tpa_master(spark, d))[1]


# (table, key of a row): the tables that carry the tenant code
RENAMED = {"raw": "get_json_object(raw_data, '$.CLAIM_ID')", "queue": "cast(queue_id as string)", "mappings": "cast(mapping_id as string)",
           "rules": "concat(rule_id, '@', target_table)", "file_log": "concat(stage, ':', file_name)", "tenants": "tpa_name"}


@register("tpa_rename", views=("v_raw", "v_queue", "v_mappings", "v_file_log", "v_tpa", "v_claim"), oracle=f"""
select table_name, case when tpa = 'asia' then 'asia_pacific' else tpa end as tpa, row_key from (
 select 'raw' as table_name, tpa, json_extract_string(raw_data, '$.CLAIM_ID') as row_key from v_raw
 union all select 'queue', tpa, cast(queue_id as varchar) from v_queue
 union all select 'mappings', tpa, cast(mapping_id as varchar) from v_mappings
 union all select 'rules', tpa, concat(r, '@', t) from (select distinct tpa, concat(claim_type, '_CLAIMS') as t from v_claim) c
   cross join (select unnest([{", ".join(repr(r[0]) for r in b.RULES)}]) as r) x
 union all select 'file_log', tpa, concat(stage, ':', file_name) from v_file_log
 union all select 'tenants', tpa_code, tpa_name from v_tpa)""")
def tpa_rename(spark, d):
    """A tenant's code changed in all tables by one commit; every row of every table, as read back."""
    store = TableSet(spark, f"{checkpoint_dir(spark).rstrip('/')}/rename-{uuid.uuid4().hex}")
    tables = {"raw": b.raw_rows(spark, d, with_ids=False), "queue": b.queue(spark, d), "mappings": b.field_mappings(spark, d), "rules": b.silver_rules(spark, d),
              "file_log": b.file_log(spark, d), "tenants": b.tpa_master(spark, d)}
    store.run("load", lambda batch: [batch.append(n, df) for n, df in tables.items()])
    br.rename_tenant(store, "asia", "asia_pacific", "rename")
    rows = [store.read(n).select(F.lit(n).alias("table_name"), F.col("tpa_code" if n == "tenants" else "tpa").alias("tpa"), F.expr(key).alias("row_key")) for n, key in RENAMED.items()]
    return functools.reduce(lambda x, y: x.unionByName(y), rows)


@register("tpa_delete_counts", views=("v_raw", "v_queue", "v_member"), oracle="""
select 'raw' as table_name, count(*) filter (where tpa = 'europe') as deleted_rows,
 count(*) filter (where tpa <> 'europe') as remaining_rows from v_raw
union all select 'queue', count(*) filter (where tpa = 'europe'), count(*) filter (where tpa <> 'europe') from v_queue
union all select 'members', count(*) filter (where tpa = 'europe'), count(*) filter (where tpa <> 'europe') from v_member""")
def tpa_delete_counts(spark, d):
    return br.cascade_delete_counts({"raw": b.raw_rows(spark, d, with_ids=False).select("tpa"), "queue": b.queue(spark, d),
                                     "members": b.members(spark, d)}, "europe")


@register("queue_kpis", views=("v_queue",), oracle="""
select count(*) as total_files, count(*) filter (where status='SUCCESS') as success_files,
 count(*) filter (where status='FAILED') as failed_files, count(*) filter (where status='PENDING') as pending_files,
 count(*) filter (where status='PROCESSING') as processing_files,
 round(cast(count(*) filter (where status='SUCCESS') as double) / nullif(cast(count(*) as double), 0) * 100, 1) as success_rate
from v_queue where file_type in ('CSV','EXCEL') and tpa in ('asia','europe','america')""")
def queue_kpis(spark, d):
    return br.queue_kpis(b.queue(spark, d), None, ["CSV", "EXCEL"], ["asia", "europe", "america"])


@register("raw_kpis", views=("v_raw",), oracle="""
select sum(n) :: bigint as total_rows, sum(f) :: bigint as unique_files,
 string_agg(concat(file_type, ':', n), ',' order by concat(file_type, ':', n)) as rows_by_type,
 min(lo) as first_load, max(hi) as last_load
from (select file_type, count(*) as n, count(distinct file_name) as f, min(load_timestamp) as lo, max(load_timestamp) as hi
      from v_raw group by file_type)""")
def raw_kpis(spark, d):
    return br.raw_kpis(b.raw_rows(spark, d, with_ids=False).select("tpa", "file_type", "file_name", "load_timestamp"))


@register("landing_kpis", views=("v_listing",), oracle="""
select stage, split_part(file_name, '/', 1) as tpa, count(*) as file_count, cast(sum(size) as bigint) as total_bytes
from v_listing where file_name like '%/%' and lower(split_part(file_name, '/', 1)) in ('asia', 'europe')
group by 1, 2""")
def landing_kpis(spark, d):
    return br.landing_kpis(b.listing(spark, d), ["ASIA", "Europe"])
