"""DuckDB text of the bindings in :mod:`claimlake.plans.bindings`.

Used only to build the oracle SQL of each registered query; each oracle is a
single statement that starts with the CTEs it needs.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_geo": ((), """
select n.n_nationkey, lower(replace(r.r_name,' ','_')) as tpa
from nation n join region r on n.n_regionkey = r.r_regionkey"""),
    "v_tpa": ((), """
select lower(replace(r_name,' ','_')) as tpa_code, r_name as tpa_name, r_regionkey <> 4 as active,
 r_regionkey as tpa_rank from region"""),
    "v_member": (("v_geo",), """
select c.c_custkey as member_id, g.tpa, c.c_name as member_name,
 date '1930-01-01' + cast((c.c_custkey*37) % 25000 as int) as date_of_birth,
 case when c.c_custkey % 3 = 0 then 'M' when c.c_custkey % 3 = 1 then 'F' else 'O' end as gender,
 date '1994-01-01' + cast(c.c_custkey % 700 as int) as enrollment_date, c.c_custkey % 4 <> 0 as is_active,
 c.c_acctbal as account_balance
from customer c join v_geo g on c.c_nationkey = g.n_nationkey"""),
    "v_provider": (("v_geo",), """
select s.s_suppkey as provider_id, s.s_name as provider_name, g.tpa,
 case s.s_nationkey % 4 when 0 then 'PRIMARY CARE' when 1 then 'CARDIOLOGY' when 2 then 'DENTISTRY' else 'PHARMACY' end as specialty,
 case when s.s_suppkey % 2 = 0 then 'Individual' else 'Facility' end as provider_type
from supplier s join v_geo g on s.s_nationkey = g.n_nationkey"""),
    "v_claim_base": (("v_member",), """
select l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate, l.l_extendedprice,
 concat_ws('-', l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber) as claim_id,
 m.tpa, o.o_custkey as member_id, l.l_suppkey as provider_id,
 case when p.p_type in ('MEDIUM','STANDARD') then 'MEDICAL' when p.p_type in ('LARGE','PROMO') then 'DENTAL' else 'PHARMACY' end as claim_type,
 cast(l.l_shipdate as date) as service_date, cast(o.o_orderdate as date) as received_date, p.p_brand as diagnosis_code,
 case o.o_orderstatus when 'F' then 'PAID' when 'P' then 'DENIED' else 'PENDING' end as claim_status,
 cast(l.l_extendedprice as decimal(18,2)) as billed_amount,
 cast(round(cast(l.l_extendedprice as decimal(18,2))*(1-cast(l.l_discount as decimal(4,2))),2) as decimal(18,2)) as allowed_amount,
 cast(round(cast(l.l_extendedprice as decimal(18,2))*(1-cast(l.l_discount as decimal(4,2)))*(1-cast(l.l_tax as decimal(4,2))),2) as decimal(18,2)) as paid_amount,
 l.l_orderkey as order_key
from lineitem l join orders o on l.l_orderkey=o.o_orderkey join v_member m on o.o_custkey=m.member_id join part p on l.l_partkey=p.p_partkey"""),
    "v_claim": (("v_claim_base",), """
select claim_id, tpa, member_id, provider_id, claim_type, service_date, received_date, diagnosis_code, claim_status,
 billed_amount, allowed_amount, paid_amount, order_key from v_claim_base"""),
    "v_claim_id": (("v_claim_base",), """
select row_number() over (order by l_orderkey,l_partkey,l_suppkey,l_linenumber,l_shipdate,l_extendedprice) as record_id,
 claim_id, tpa, member_id, provider_id, claim_type, service_date, received_date, diagnosis_code, claim_status,
 billed_amount, allowed_amount, paid_amount, order_key from v_claim_base"""),
    "v_queue": (("v_member",), """
select o.o_orderkey as queue_id,
 concat(m.tpa,'/order-',o.o_orderkey, case o.o_orderkey % 4 when 0 then '.csv' when 1 then '.CSV.gz' when 2 then '.xlsx' else '.txt' end) as file_name, m.tpa,
 cast(floor(o.o_totalprice) as bigint) as file_size_bytes,
 case when o.o_orderstatus='F' then 'SUCCESS' when o.o_orderstatus='P' then 'FAILED' when o.o_orderkey % 5 = 0 then 'PROCESSING' else 'PENDING' end as status,
 o.o_orderdate as discovered_timestamp,
 case when o.o_orderstatus in ('F','P') then o.o_orderdate + interval '1' second * (o.o_orderkey % 3600) end as processed_timestamp,
 cast(o.o_orderkey % 5 as int) as retry_count,
 case when upper(concat(m.tpa,'/order-',o.o_orderkey, case o.o_orderkey % 4 when 0 then '.csv' when 1 then '.CSV.gz' when 2 then '.xlsx' else '.txt' end)) like '%.CSV%' then 'CSV'
      when o.o_orderkey % 4 = 2 then 'EXCEL' else 'UNKNOWN' end as file_type
from orders o join v_member m on o.o_custkey=m.member_id"""),
    "v_raw": (("v_claim_id",), """
select record_id,
 concat(tpa,'/order-',order_key, case order_key % 4 when 0 then '.csv' when 1 then '.CSV.gz' when 2 then '.xlsx' else '.txt' end) as file_name,
 row_number() over (partition by order_key order by record_id) as file_row_number,
 tpa,
 json_object('CLAIM_ID', claim_id, 'MEMBER_ID', cast(member_id as varchar), 'PROVIDER_ID', cast(provider_id as varchar),
   'CLAIM_TYPE', claim_type, 'SERVICE_DATE', cast(service_date as varchar), 'DIAGNOSIS_CODE', diagnosis_code,
   'CLAIM_STATUS', claim_status, 'BILLED_AMOUNT', cast(billed_amount as varchar),
   'ALLOWED_AMOUNT', cast(allowed_amount as varchar), 'PAID_AMOUNT', cast(paid_amount as varchar)) as raw_data,
 case order_key % 4 when 0 then 'CSV' when 1 then 'CSV' when 2 then 'EXCEL' else 'UNKNOWN' end as file_type,
 cast(received_date as timestamp) + interval '1' second * (order_key % 3600) as load_timestamp,
 'loader' as loaded_by
from v_claim_id"""),
    "v_listing": (("v_queue",), """
select case status when 'SUCCESS' then 'COMPLETED' when 'FAILED' then 'ERROR' else 'SRC' end as stage,
 file_name, file_size_bytes as size, coalesce(processed_timestamp, discovered_timestamp) as modification_time
from v_queue"""),
    "v_error": (("v_log",), """
select log_id as error_id, log_timestamp as error_timestamp, log_source as error_source, message as error_message,
 value > 10 as resolved from v_log where log_level = 'ERROR'"""),
    "v_api": ((), """
select event_id as request_id, ts as log_timestamp, concat('/api/', event_type) as path,
 cast(floor(value * 100) as bigint) as latency_ms from events"""),
    "v_task": (("v_queue",), """
select queue_id as run_id, concat('process_', tpa) as task_name, discovered_timestamp as start_time,
 processed_timestamp as end_time, status from v_queue"""),
    "v_file_log": (("v_queue",), """
select file_name, tpa, 'DISCOVER' as stage, 'SUCCESS' as status, discovered_timestamp as log_timestamp,
 cast(0 as bigint) as rows_processed, cast(0 as bigint) as rows_failed from v_queue
union all
select file_name, tpa, 'PROCESS', status, processed_timestamp, cast(file_size_bytes % 1000 as bigint),
 cast(case when status = 'FAILED' then retry_count else 0 end as bigint) from v_queue where status in ('SUCCESS','FAILED')"""),
    "v_defs": (("v_claim",), """
with s as (select concat(claim_type, '_CLAIMS') as table_name, tpa, cast(claim_id as varchar) as CLAIM_ID, cast(member_id as varchar) as MEMBER_ID, cast(provider_id as varchar) as PROVIDER_ID, cast(service_date as varchar) as SERVICE_DATE, cast(received_date as varchar) as RECEIVED_DATE, cast(diagnosis_code as varchar) as DIAGNOSIS_CODE, cast(claim_status as varchar) as CLAIM_STATUS, cast(billed_amount as varchar) as BILLED_AMOUNT, cast(allowed_amount as varchar) as ALLOWED_AMOUNT, cast(paid_amount as varchar) as PAID_AMOUNT from v_claim),
g as (select table_name, bool_and(CLAIM_ID is null or try_cast(CLAIM_ID as decimal(18,2)) is not null) as CLAIM_ID__num, bool_and(CLAIM_ID is null or try_cast(CLAIM_ID as date) is not null) as CLAIM_ID__date, max(length(CLAIM_ID)) as CLAIM_ID__len, count(*) filter (where CLAIM_ID is null) as CLAIM_ID__nulls,
 bool_and(MEMBER_ID is null or try_cast(MEMBER_ID as decimal(18,2)) is not null) as MEMBER_ID__num, bool_and(MEMBER_ID is null or try_cast(MEMBER_ID as date) is not null) as MEMBER_ID__date, max(length(MEMBER_ID)) as MEMBER_ID__len, count(*) filter (where MEMBER_ID is null) as MEMBER_ID__nulls,
 bool_and(PROVIDER_ID is null or try_cast(PROVIDER_ID as decimal(18,2)) is not null) as PROVIDER_ID__num, bool_and(PROVIDER_ID is null or try_cast(PROVIDER_ID as date) is not null) as PROVIDER_ID__date, max(length(PROVIDER_ID)) as PROVIDER_ID__len, count(*) filter (where PROVIDER_ID is null) as PROVIDER_ID__nulls,
 bool_and(SERVICE_DATE is null or try_cast(SERVICE_DATE as decimal(18,2)) is not null) as SERVICE_DATE__num, bool_and(SERVICE_DATE is null or try_cast(SERVICE_DATE as date) is not null) as SERVICE_DATE__date, max(length(SERVICE_DATE)) as SERVICE_DATE__len, count(*) filter (where SERVICE_DATE is null) as SERVICE_DATE__nulls,
 bool_and(RECEIVED_DATE is null or try_cast(RECEIVED_DATE as decimal(18,2)) is not null) as RECEIVED_DATE__num, bool_and(RECEIVED_DATE is null or try_cast(RECEIVED_DATE as date) is not null) as RECEIVED_DATE__date, max(length(RECEIVED_DATE)) as RECEIVED_DATE__len, count(*) filter (where RECEIVED_DATE is null) as RECEIVED_DATE__nulls,
 bool_and(DIAGNOSIS_CODE is null or try_cast(DIAGNOSIS_CODE as decimal(18,2)) is not null) as DIAGNOSIS_CODE__num, bool_and(DIAGNOSIS_CODE is null or try_cast(DIAGNOSIS_CODE as date) is not null) as DIAGNOSIS_CODE__date, max(length(DIAGNOSIS_CODE)) as DIAGNOSIS_CODE__len, count(*) filter (where DIAGNOSIS_CODE is null) as DIAGNOSIS_CODE__nulls,
 bool_and(CLAIM_STATUS is null or try_cast(CLAIM_STATUS as decimal(18,2)) is not null) as CLAIM_STATUS__num, bool_and(CLAIM_STATUS is null or try_cast(CLAIM_STATUS as date) is not null) as CLAIM_STATUS__date, max(length(CLAIM_STATUS)) as CLAIM_STATUS__len, count(*) filter (where CLAIM_STATUS is null) as CLAIM_STATUS__nulls,
 bool_and(BILLED_AMOUNT is null or try_cast(BILLED_AMOUNT as decimal(18,2)) is not null) as BILLED_AMOUNT__num, bool_and(BILLED_AMOUNT is null or try_cast(BILLED_AMOUNT as date) is not null) as BILLED_AMOUNT__date, max(length(BILLED_AMOUNT)) as BILLED_AMOUNT__len, count(*) filter (where BILLED_AMOUNT is null) as BILLED_AMOUNT__nulls,
 bool_and(ALLOWED_AMOUNT is null or try_cast(ALLOWED_AMOUNT as decimal(18,2)) is not null) as ALLOWED_AMOUNT__num, bool_and(ALLOWED_AMOUNT is null or try_cast(ALLOWED_AMOUNT as date) is not null) as ALLOWED_AMOUNT__date, max(length(ALLOWED_AMOUNT)) as ALLOWED_AMOUNT__len, count(*) filter (where ALLOWED_AMOUNT is null) as ALLOWED_AMOUNT__nulls,
 bool_and(PAID_AMOUNT is null or try_cast(PAID_AMOUNT as decimal(18,2)) is not null) as PAID_AMOUNT__num, bool_and(PAID_AMOUNT is null or try_cast(PAID_AMOUNT as date) is not null) as PAID_AMOUNT__date, max(length(PAID_AMOUNT)) as PAID_AMOUNT__len, count(*) filter (where PAID_AMOUNT is null) as PAID_AMOUNT__nulls from s group by table_name)
select table_name, 'CLAIM_ID' as column_name, case when CLAIM_ID__num then 'NUMBER(18,2)' when CLAIM_ID__date then 'DATE' else concat('VARCHAR(', case when CLAIM_ID__len <= 50 then '50' when CLAIM_ID__len <= 100 then '100' else '500' end, ')') end as data_type, case when CLAIM_ID__nulls > 0 then 'Y' else 'N' end as nullable, case when CLAIM_ID__num then '0.00' when CLAIM_ID__date then 'CURRENT_DATE()' when CLAIM_ID__nulls = 0 then 'N/A' end as default_value, 'Observed claim_id' as description from g
union all select table_name, 'MEMBER_ID' as column_name, case when MEMBER_ID__num then 'NUMBER(18,2)' when MEMBER_ID__date then 'DATE' else concat('VARCHAR(', case when MEMBER_ID__len <= 50 then '50' when MEMBER_ID__len <= 100 then '100' else '500' end, ')') end as data_type, case when MEMBER_ID__nulls > 0 then 'Y' else 'N' end as nullable, case when MEMBER_ID__num then '0.00' when MEMBER_ID__date then 'CURRENT_DATE()' when MEMBER_ID__nulls = 0 then 'N/A' end as default_value, 'Observed member_id' as description from g
union all select table_name, 'PROVIDER_ID' as column_name, case when PROVIDER_ID__num then 'NUMBER(18,2)' when PROVIDER_ID__date then 'DATE' else concat('VARCHAR(', case when PROVIDER_ID__len <= 50 then '50' when PROVIDER_ID__len <= 100 then '100' else '500' end, ')') end as data_type, case when PROVIDER_ID__nulls > 0 then 'Y' else 'N' end as nullable, case when PROVIDER_ID__num then '0.00' when PROVIDER_ID__date then 'CURRENT_DATE()' when PROVIDER_ID__nulls = 0 then 'N/A' end as default_value, 'Observed provider_id' as description from g
union all select table_name, 'SERVICE_DATE' as column_name, case when SERVICE_DATE__num then 'NUMBER(18,2)' when SERVICE_DATE__date then 'DATE' else concat('VARCHAR(', case when SERVICE_DATE__len <= 50 then '50' when SERVICE_DATE__len <= 100 then '100' else '500' end, ')') end as data_type, case when SERVICE_DATE__nulls > 0 then 'Y' else 'N' end as nullable, case when SERVICE_DATE__num then '0.00' when SERVICE_DATE__date then 'CURRENT_DATE()' when SERVICE_DATE__nulls = 0 then 'N/A' end as default_value, 'Observed service_date' as description from g
union all select table_name, 'RECEIVED_DATE' as column_name, case when RECEIVED_DATE__num then 'NUMBER(18,2)' when RECEIVED_DATE__date then 'DATE' else concat('VARCHAR(', case when RECEIVED_DATE__len <= 50 then '50' when RECEIVED_DATE__len <= 100 then '100' else '500' end, ')') end as data_type, case when RECEIVED_DATE__nulls > 0 then 'Y' else 'N' end as nullable, case when RECEIVED_DATE__num then '0.00' when RECEIVED_DATE__date then 'CURRENT_DATE()' when RECEIVED_DATE__nulls = 0 then 'N/A' end as default_value, 'Observed received_date' as description from g
union all select table_name, 'DIAGNOSIS_CODE' as column_name, case when DIAGNOSIS_CODE__num then 'NUMBER(18,2)' when DIAGNOSIS_CODE__date then 'DATE' else concat('VARCHAR(', case when DIAGNOSIS_CODE__len <= 50 then '50' when DIAGNOSIS_CODE__len <= 100 then '100' else '500' end, ')') end as data_type, case when DIAGNOSIS_CODE__nulls > 0 then 'Y' else 'N' end as nullable, case when DIAGNOSIS_CODE__num then '0.00' when DIAGNOSIS_CODE__date then 'CURRENT_DATE()' when DIAGNOSIS_CODE__nulls = 0 then 'N/A' end as default_value, 'Observed diagnosis_code' as description from g
union all select table_name, 'CLAIM_STATUS' as column_name, case when CLAIM_STATUS__num then 'NUMBER(18,2)' when CLAIM_STATUS__date then 'DATE' else concat('VARCHAR(', case when CLAIM_STATUS__len <= 50 then '50' when CLAIM_STATUS__len <= 100 then '100' else '500' end, ')') end as data_type, case when CLAIM_STATUS__nulls > 0 then 'Y' else 'N' end as nullable, case when CLAIM_STATUS__num then '0.00' when CLAIM_STATUS__date then 'CURRENT_DATE()' when CLAIM_STATUS__nulls = 0 then 'N/A' end as default_value, 'Observed claim_status' as description from g
union all select table_name, 'BILLED_AMOUNT' as column_name, case when BILLED_AMOUNT__num then 'NUMBER(18,2)' when BILLED_AMOUNT__date then 'DATE' else concat('VARCHAR(', case when BILLED_AMOUNT__len <= 50 then '50' when BILLED_AMOUNT__len <= 100 then '100' else '500' end, ')') end as data_type, case when BILLED_AMOUNT__nulls > 0 then 'Y' else 'N' end as nullable, case when BILLED_AMOUNT__num then '0.00' when BILLED_AMOUNT__date then 'CURRENT_DATE()' when BILLED_AMOUNT__nulls = 0 then 'N/A' end as default_value, 'Observed billed_amount' as description from g
union all select table_name, 'ALLOWED_AMOUNT' as column_name, case when ALLOWED_AMOUNT__num then 'NUMBER(18,2)' when ALLOWED_AMOUNT__date then 'DATE' else concat('VARCHAR(', case when ALLOWED_AMOUNT__len <= 50 then '50' when ALLOWED_AMOUNT__len <= 100 then '100' else '500' end, ')') end as data_type, case when ALLOWED_AMOUNT__nulls > 0 then 'Y' else 'N' end as nullable, case when ALLOWED_AMOUNT__num then '0.00' when ALLOWED_AMOUNT__date then 'CURRENT_DATE()' when ALLOWED_AMOUNT__nulls = 0 then 'N/A' end as default_value, 'Observed allowed_amount' as description from g
union all select table_name, 'PAID_AMOUNT' as column_name, case when PAID_AMOUNT__num then 'NUMBER(18,2)' when PAID_AMOUNT__date then 'DATE' else concat('VARCHAR(', case when PAID_AMOUNT__len <= 50 then '50' when PAID_AMOUNT__len <= 100 then '100' else '500' end, ')') end as data_type, case when PAID_AMOUNT__nulls > 0 then 'Y' else 'N' end as nullable, case when PAID_AMOUNT__num then '0.00' when PAID_AMOUNT__date then 'CURRENT_DATE()' when PAID_AMOUNT__nulls = 0 then 'N/A' end as default_value, 'Observed paid_amount' as description from g
union all select table_name, 'CREATED_AT', 'TIMESTAMP_NTZ', 'N', cast('CURRENT_TIMESTAMP()' as varchar), 'Declared created_at' from g
union all select table_name, 'PROCESSED_DATE', 'TIMESTAMP_NTZ', 'Y', cast(null as varchar), 'Declared processed_date' from g
union all select table_name, 'SERVICE_YEAR', 'NUMBER(4,0)', 'Y', cast('TBD' as varchar), 'Declared service_year' from g
union all select table_name, 'IS_ADJUSTED', 'BOOLEAN', 'N', cast('maybe' as varchar), 'Declared is_adjusted' from g
union all select table_name, 'ADJUSTED_DATE', 'DATE', 'Y', cast('CURRENT_TIMESTAMP()' as varchar), 'Declared adjusted_date' from g"""),
    "v_mappings": (("v_claim", "v_tpa"), """
select cast(t.tpa_rank as bigint) * 100000 + case claim_type when 'MEDICAL' then 1 when 'DENTAL' then 2 else 3 end * 1000
   + list_position(['CLAIM_ID', 'MEMBER_ID', 'PROVIDER_ID', 'SERVICE_DATE', 'RECEIVED_DATE', 'DIAGNOSIS_CODE', 'CLAIM_STATUS', 'BILLED_AMOUNT', 'ALLOWED_AMOUNT', 'PAID_AMOUNT'], source_field) as mapping_id,
 source_field, 'RAW_DATA_TABLE' as source_table, target_table,
 case when tpa = 'asia' and source_field = 'ALLOWED_AMOUNT' then 'PAID_AMOUNT' when source_field = 'CLAIM_STATUS' then 'STATUS'
      else source_field end as target_column, tpa,
 case when tpa in ('asia','europe') then 'MANUAL' when tpa = 'america' then 'ML_AUTO' when tpa = 'africa' then 'LLM_CORTEX'
      else 'FUZZY' end as mapping_method,
 case when tpa in ('asia','europe') then 1.0 else cast(5 + length(source_field) % 5 as double) / 10 end as confidence_score,
 (tpa in ('asia','europe') or cast(5 + length(source_field) % 5 as double) / 10 >= 0.8) as approved,
 true as active,
 case when source_field like '%AMOUNT' then concat('TO_NUMBER(', source_field, ')')
      when source_field like '%DATE' then concat('TO_DATE(', source_field, ')') end as transformation_logic
from (select tpa, claim_type, concat(claim_type, '_CLAIMS') as target_table, unnest(['CLAIM_ID', 'MEMBER_ID', 'PROVIDER_ID', 'SERVICE_DATE', 'RECEIVED_DATE', 'DIAGNOSIS_CODE', 'CLAIM_STATUS', 'BILLED_AMOUNT', 'ALLOWED_AMOUNT', 'PAID_AMOUNT']) as source_field
      from (select distinct tpa, claim_type from v_claim)) c join v_tpa t on c.tpa = t.tpa_code"""),
    "v_src_fields": (("v_raw",), """
select distinct tpa, unnest(json_keys(raw_data)) as source_field from v_raw"""),
    "v_event": ((), """
select concat('EVT-', e.event_id) as event_id, concat('JRN-', e.user_id, '-', e.event_type) as journey_id, e.user_id as member_id, e.event_type,
 cast(e.ts as date) as event_date, cast(e.value as decimal(18,2)) as cost, cast(regexp_replace(e.props,'[^0-9]','','g') as int) as provider_id,
 e.event_id as event_seq
from events e"""),
    "v_journey0": (("v_event", "v_member"), """
select e.journey_id, e.member_id, m.tpa, e.event_type as journey_type, min(e.event_date) as start_date,
 case when max(e.event_date) < date '2024-01-27' then max(e.event_date) end as end_date, max(e.event_date) >= date '2024-01-27' as is_active,
 cast(sum(e.cost) as decimal(18,2)) as total_cost, count(*) as num_visits, count(distinct e.provider_id) as num_providers
from v_event e join v_member m on e.member_id=m.member_id group by e.journey_id, e.member_id, m.tpa, e.event_type"""),
    "v_journey": (("v_journey0",), """
select *, case when is_active then 'IN_PROGRESS' else 'COMPLETED' end as current_stage,
 cast(case when not is_active then 3 + num_visits % 3 end as int) as quality_score,
 cast(case when not is_active then 3 + num_providers % 3 end as int) as patient_satisfaction
from v_journey0"""),
    "v_log": ((), """
select event_id as log_id, ts as log_timestamp,
 case when event_type='error' then 'ERROR' when event_type='signup' then 'WARNING' else 'INFO' end as log_level,
 case user_id % 3 when 0 then 'BRONZE' when 1 then 'SILVER' else 'GOLD' end as log_source,
 concat('event ', event_type, ' user ', cast(user_id as varchar)) as message,
 user_id, value, props as details
from events"""),
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs ``names`` need, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} as ({VIEWS[n][1].strip()})" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
