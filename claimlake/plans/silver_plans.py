"""Registered silver transform and rules plans (TRF-*, RUL-*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from claimlake.operators import rules as ru
from claimlake.operators import transform as tr
from claimlake.plans import bindings as b
from claimlake.plans.quality_plans import METRICS_SQL
from claimlake.plans.quality_plans import metrics as dq_metrics_df
from claimlake.plans.registry import register
from claimlake.session import written
from claimlake.sources.tables import table

TABLE = "MEDICAL_CLAIMS"
RULES_AS_OF = _dt.date(1998, 6, 30)
TRANSFORM_AS_OF = _dt.datetime(2001, 12, 31, 0, 0, 0)
OLD_BEFORE = _dt.datetime(1998, 1, 1)
QUEUE_AS_OF = _dt.datetime(2001, 8, 2)


def _targets() -> list[str]:
    cols = set()
    for f in b.CLAIM_FIELDS:
        cols.add("STATUS" if f == "CLAIM_STATUS" else f)
    return sorted(cols)


def _projection_sql(extra: str = "", typed: bool = False) -> str:
    def value(t):
        kind = "decimal(18,2)" if t.endswith("AMOUNT") else "date" if t.endswith("DATE") else None
        return f"try_cast(v as {kind})" if typed and kind else "v"
    cols = ",\n ".join(
        f"arg_min({value(t)}, mapping_id) filter (where target_column = '{t}' and {value(t)} is not null) as {t}" for t in _targets())
    return f"""
with m as (select * from v_mappings where approved and coalesce(active, true) and target_table = '{TABLE}'),
kv as (select r.record_id, r.file_name, r.file_row_number, r.tpa, m.target_column, m.mapping_id,
         json_extract_string(r.raw_data, '$.' || m.source_field) as v
       from v_raw r join m on r.tpa = m.tpa {extra})
select record_id, file_name, file_row_number, tpa,
 {cols}
from kv group by record_id, file_name, file_row_number, tpa"""


def projection(spark, d):
    return tr.project_mapped(b.raw_rows(spark, d), b.field_mappings(spark, d), TABLE)


@register("bronze_to_silver", views=("v_raw", "v_mappings"), oracle=_projection_sql())
def bronze_to_silver(spark, d):
    return projection(spark, d)


@register("bronze_to_silver_typed", views=("v_raw", "v_mappings"), oracle=_projection_sql(typed=True))
def bronze_to_silver_typed(spark, d):
    return tr.project_mapped(b.raw_rows(spark, d), b.field_mappings(spark, d), TABLE, apply_logic=True,
                             as_of=TRANSFORM_AS_OF)


@register("silver_merge", views=("v_raw", "v_mappings"), oracle=f"""
with p as ({_projection_sql()})
select record_id as _record_id, file_name as _file_name, file_row_number as _file_row_number, tpa as _tpa,
 {", ".join(_targets())}, 'B2' as _batch_id, timestamp '{TRANSFORM_AS_OF}' as _load_timestamp, 'claimlake' as _loaded_by
from p""")
def silver_merge(spark, d):
    raw, pairs = b.stored_raw_rows(spark, d)  # both batches read them: joined and numbered once
    m = written(b.field_mappings(spark, d, pairs), "mappings")  # of known size, so that the rows meet them without being dealt by tenant
    old = tr.with_lineage(tr.project_mapped(raw.filter(F.col("load_timestamp") < F.lit(OLD_BEFORE)), m, TABLE),
                          "B1", "1998-01-01 00:00:00")
    new = tr.with_lineage(tr.project_mapped(raw, m, TABLE), "B2", TRANSFORM_AS_OF)
    return tr.merge_silver(old, new)


@register("incremental_slice", views=("v_raw",), oracle=f"""
with wm as (select tpa, max(record_id) as last_processed_id from v_raw
            where load_timestamp < timestamp '{OLD_BEFORE}' group by tpa)
select r.record_id, r.file_name, r.file_row_number, r.tpa from v_raw r left join wm on r.tpa = wm.tpa
where r.record_id > coalesce(wm.last_processed_id, -1)""")
def incremental_slice(spark, d):
    raw = b.raw_rows(spark, d).select("record_id", "file_name", "file_row_number", "tpa", "load_timestamp")
    processed = raw.filter(F.col("load_timestamp") < F.lit(OLD_BEFORE))
    empty = spark.createDataFrame([], "source_table string, target_table string, tpa string, "
                                      "last_processed_id long, updated_at timestamp_ntz")
    wm = tr.advance_watermarks(empty, processed, "RAW_DATA_TABLE", TABLE, OLD_BEFORE)
    return tr.incremental_slice(raw, wm, "RAW_DATA_TABLE", TABLE).drop("load_timestamp")


@register("plan_runs", views=("v_mappings",), oracle="""
select tpa, target_table, count(*) as mapping_count from v_mappings where approved and coalesce(active, true)
group by tpa, target_table""")
def plan_runs(spark, d):
    return tr.plan_runs(b.field_mappings(spark, d))


@register("auto_transform_status", views=("v_task",), oracle=f"""
select cast(start_time as date) as run_date, count(*) as total_runs, count(*) filter (where status = 'SUCCESS') as successful_runs,
 count(*) filter (where status in ('FAILED', 'PARTIAL')) as failed_runs, max(start_time) as last_run
from v_task where start_time >= timestamp '{QUEUE_AS_OF}' - interval 30 day and start_time <= timestamp '{QUEUE_AS_OF}'
group by 1""")
def auto_transform_status(spark, d):
    return tr.run_status(b.task_runs(spark, d), QUEUE_AS_OF, 30)


@register("silver_page", views=("v_raw", "v_mappings"), oracle=f"""
with p as ({_projection_sql()})
select record_id as _record_id, file_name as _file_name, file_row_number as _file_row_number, tpa as _tpa,
 {", ".join(_targets())}, 'B1' as _batch_id, timestamp '{TRANSFORM_AS_OF}' as _load_timestamp, 'claimlake' as _loaded_by
from p order by record_id limit 100""")
def silver_page(spark, d):
    return tr.silver_page(tr.with_lineage(projection(spark, d), "B1", TRANSFORM_AS_OF), 100)


@register("silver_stats", views=("v_raw", "v_mappings"), oracle=METRICS_SQL + f""",
last as (select * from metrics where target_table = '{TABLE}' and tpa = 'asia'
         qualify row_number() over (order by measured_timestamp desc, batch_id desc, metric_name) <= 20)
select count(*) as checks, count(*) filter (where passed) as passed_checks, max(measured_timestamp) as last_check,
 (select count(*) from v_raw where tpa in (select tpa from v_mappings where approved and coalesce(active, true) and target_table = '{TABLE}')) as row_count,
 case when count(*) > 0 then round(cast(count(*) filter (where passed) as double) * 100 / cast(count(*) as double), 1) end as quality_score
from last""")
def silver_stats(spark, d):
    # joined once; rows are counted, so they need no ids
    c = written(b.claims(spark, d), "claims")
    silver = tr.project_mapped(b.raw_rows(spark, d, with_ids=False, claim_rows=c), b.field_mappings(spark, d, c), TABLE)
    return tr.silver_stats(silver, dq_metrics_df(spark, d, c), TABLE, "asia", 20)


# -- rules --------------------------------------------------------------------------

RULE_SQL = {
    "DQ001": "claim_id is not null",
    "DQ002": f"service_date <= date '{RULES_AS_OF}'",
    "DQ003": "billed_amount >= 0",
    "DQ004": "paid_amount <= 80000",
}
RULE_ACTION = {"DQ001": "REJECT", "DQ002": "QUARANTINE", "DQ003": "QUARANTINE", "DQ004": "FLAG", "DQ006": "FLAG"}


def _joined(spark, d, *cols):
    """These columns of the claims and the (tenant, claim type) pairs in them, both written: the claims are joined once for rules and rows."""
    c = written(b.claims(spark, d).select("claim_id", "tpa", "claim_type", *cols), "claims")
    rows = c.select("claim_id", "tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("table_name"), *cols)
    return rows, written(c.select("tpa", "claim_type").distinct(), "claims-profile")


def _checked_by(spark, d):
    """The checked claims, and the rules."""
    c, profile = _joined(spark, d, "service_date", "billed_amount", "paid_amount", "diagnosis_code")
    rules = b.silver_rules(spark, d, profile)
    out, _errors = ru.apply_rules(c, rules, RULES_AS_OF, table_col="table_name")
    return out, rules


def _checked(spark, d):
    return _checked_by(spark, d)[0]


# All three claim tables: each row meets the rules of its tenant and table; the aggregate rule is taken per tenant and table.
FAILS_SQL = f"""
with c as (select claim_id, tpa, concat(claim_type, '_CLAIMS') as table_name, service_date, billed_amount, paid_amount, diagnosis_code from v_claim),
a as (select tpa, table_name, coalesce(avg(billed_amount) < 38000, false) as ok6 from c group by tpa, table_name),
f as (select c.*, list_filter([{", ".join(f"case when not coalesce({v}, false) then '{k}' end" for k, v in RULE_SQL.items())},
        case when not a.ok6 then 'DQ006' end], lambda x: x is not null) as failed
      from c join a on c.tpa = a.tpa and c.table_name = a.table_name)"""


@register("dq_rule_failures", views=("v_claim",), oracle=FAILS_SQL + """
select claim_id, tpa, table_name, array_to_string(list_sort(failed), ',') as failed_rules from f""")
def dq_rule_failures(spark, d):
    out = _checked(spark, d)
    return out.select("claim_id", "tpa", "table_name", F.array_join(F.array_sort("_failed_rules"), ",").alias("failed_rules"))


@register("business_logic_cols", views=("v_claim",), oracle="""
select claim_id, tpa, concat(claim_type, '_CLAIMS') as table_name,
 cast(paid_amount as double) / nullif(cast(billed_amount as double), 0) as discount_rate,
 upper(trim(diagnosis_code)) as diagnosis_code
from v_claim""")
def business_logic_cols(spark, d):
    out = _checked(spark, d)
    return out.select("claim_id", "tpa", "table_name", F.col("DISCOUNT_RATE").cast("double").alias("discount_rate"),
                      "diagnosis_code")


ACTION_SQL = """case when list_contains(failed, 'DQ001') then 'REJECT'
 when list_contains(failed, 'DQ002') or list_contains(failed, 'DQ003') then 'QUARANTINE'
 when len(failed) > 0 then 'FLAG' end"""


@register("rule_routing_counts", views=("v_claim",), oracle=FAILS_SQL + f"""
select tpa, table_name, count(*) as input_rows, count(*) filter (where {ACTION_SQL} is null) as clean_rows,
 count(*) filter (where {ACTION_SQL} in ('FLAG', 'CORRECT')) as flagged_rows,
 count(*) filter (where {ACTION_SQL} = 'QUARANTINE') as quarantined_rows,
 count(*) filter (where {ACTION_SQL} = 'REJECT') as rejected_rows
from f group by tpa, table_name""")
def rule_routing_counts(spark, d):
    return ru.routing_counts(_checked(spark, d), table_col="table_name")


@register("quarantine_rows", views=("v_claim",), oracle=FAILS_SQL + f"""
select 'Q1' as batch_id, tpa, 'RAW_DATA_TABLE' as source_table, table_name as target_table, claim_id, rule_id,
 r.rule_name, concat('Failed rule: ', r.rule_logic) as failure_reason
from (select *, unnest(failed) as rule_id from f where {ACTION_SQL} = 'QUARANTINE') q
join (select * from (values {", ".join(f"('{a}', '{n}', '{lg.replace(chr(39), chr(39) * 2)}')" for a, n, _t, _c, lg, *_r in b.RULES)})
      as t(rid, rule_name, rule_logic)) r on q.rule_id = r.rid""")
def quarantine_rows(spark, d):
    checked, rules = _checked_by(spark, d)
    _clean, q, _rej = ru.route(checked)
    out = ru.to_quarantine(q, rules, "Q1", RULES_AS_OF, "RAW_DATA_TABLE", None, id_col="claim_id",
                           table_col="table_name")
    return out.drop("record_data", "quarantine_timestamp", "reprocessed")


# -- corrections ----------------------------------------------------------------------

# Fixed values: (rule_id, target column, logic, correction, fallback).  The second reads what the first may set; CR003 cannot mend
# bills that are not positive, so those rows fall to its fallback; CR004 has no correction.
CORRECT_RULES = [
    ("CR001", "ALLOWED_AMOUNT", "ALLOWED_AMOUNT <= 0.95 * BILLED_AMOUNT", "ROUND(0.95 * BILLED_AMOUNT, 2)", None),
    ("CR002", "PAID_AMOUNT", "PAID_AMOUNT <= 0.97 * ALLOWED_AMOUNT", "ROUND(0.9 * ALLOWED_AMOUNT, 2)", None),
    ("CR003", "BILLED_AMOUNT", "BILLED_AMOUNT <= 60000", "IFF(BILLED_AMOUNT <= 70000, 60000, BILLED_AMOUNT)", "QUARANTINE"),
    ("CR004", "DIAGNOSIS_CODE", "DIAGNOSIS_CODE <> 'Brand#11'", None, "REJECT"),
]


def correct_rules(spark, d, profile=None):
    """The corrections for every tenant and table of the claims but America's dental ones."""
    items = [F.struct(F.lit(i).alias("rule_id"), F.lit(i).alias("rule_name"), F.lit("DATA_QUALITY").alias("rule_type"), F.lit(c).alias("target_column"),
                      F.lit(lg).alias("rule_logic"), F.lit("CORRECT").alias("error_action"), F.lit(n).alias("priority"), F.lit(True).alias("active"),
                      F.lit(fix).cast("string").alias("correction"), F.lit(fb).cast("string").alias("fallback_action"))
             for n, (i, c, lg, fix, fb) in enumerate(CORRECT_RULES)]
    keys = b.silver_rules(spark, d, profile).select("tpa", "target_table").distinct().filter("not (tpa = 'america' and target_table = 'DENTAL_CLAIMS')")
    return keys.select("tpa", "target_table", F.inline(F.array(*items)))


def _mended(spark, d):
    c, profile = _joined(spark, d, "billed_amount", "allowed_amount", "paid_amount", "diagnosis_code")
    out, _errors = ru.apply_rules(c, correct_rules(spark, d, profile), RULES_AS_OF, table_col="table_name")
    return out


# The sweep in SQL, one step after the other: allowed, paid, billed; then, as a new bill can break the limit on allowed (a lower one only
# raises no other rule than CR001, which the row may still use if it did not), allowed and paid once more.
MENDED_SQL = """
with r0 as (select claim_id, tpa, concat(claim_type, '_CLAIMS') as table_name, diagnosis_code, billed_amount as b0, allowed_amount as a0, paid_amount as p0,
  not (tpa = 'america' and claim_type = 'DENTAL') as held from v_claim),
r1 as (select *, held and not (a0 <= 0.95 * b0) as x1, cast(case when held and not (a0 <= 0.95 * b0) then round(0.95 * b0, 2) else a0 end as decimal(18,2)) as a1 from r0),
r2 as (select *, held and not (p0 <= 0.97 * a1) as x2, cast(case when held and not (p0 <= 0.97 * a1) then round(0.9 * a1, 2) else p0 end as decimal(18,2)) as p1 from r1),
r3 as (select *, held and not (b0 <= 60000) as x3, cast(case when held and not (b0 <= 60000) and b0 <= 70000 then 60000 else b0 end as decimal(18,2)) as b1 from r2),
r4 as (select *, held and not x1 and not (a1 <= 0.95 * b1) as x4,
  cast(case when held and not x1 and not (a1 <= 0.95 * b1) then round(0.95 * b1, 2) else a1 end as decimal(18,2)) as a2 from r3),
r5 as (select *, held and not x2 and not (p1 <= 0.97 * a2) as x5,
  cast(case when held and not x2 and not (p1 <= 0.97 * a2) then round(0.9 * a2, 2) else p1 end as decimal(18,2)) as p2 from r4),
m as (select *, list_filter([case when held and not (a2 <= 0.95 * b1) then 'CR001' end, case when held and not (p2 <= 0.97 * a2) then 'CR002' end,
  case when held and not (b1 <= 60000) then 'CR003' end, case when held and not (diagnosis_code <> 'Brand#11') then 'CR004' end], lambda x: x is not null) as failed from r5)"""


@register("corrected_rows", views=("v_claim",), oracle=MENDED_SQL + """
select claim_id, tpa, table_name, b1 as billed_amount, a2 as allowed_amount, p2 as paid_amount,
 cast(x1 as int) + cast(x2 as int) + cast(x3 as int) + cast(x4 as int) + cast(x5 as int) as corrections, array_to_string(failed, ',') as failed_rules,
 case when list_contains(failed, 'CR004') then 'REJECT' when list_contains(failed, 'CR003') then 'QUARANTINE' when len(failed) > 0 then 'FLAG' end as action
from m""")
def corrected_rows(spark, d):
    return _mended(spark, d).select("claim_id", "tpa", "table_name", "billed_amount", "allowed_amount", "paid_amount", F.size("_corrections").alias("corrections"),
                                    F.array_join("_failed_rules", ",").alias("failed_rules"), ru.strictest_action(F.col("_failed_actions")).alias("action"))


@register("correction_audit", views=("v_claim",), oracle=MENDED_SQL + """,
s as (select claim_id, tpa, table_name, failed, unnest([
  struct_pack(n := 1, x := x1, rule_id := 'CR001', target_column := 'allowed_amount', before := a0, after := a1),
  struct_pack(n := 2, x := x2, rule_id := 'CR002', target_column := 'paid_amount', before := p0, after := p1),
  struct_pack(n := 3, x := x3, rule_id := 'CR003', target_column := 'billed_amount', before := b0, after := b1),
  struct_pack(n := 4, x := x4, rule_id := 'CR001', target_column := 'allowed_amount', before := a1, after := a2),
  struct_pack(n := 5, x := x5, rule_id := 'CR002', target_column := 'paid_amount', before := p1, after := p2)]) as c from m)
select 'C1' as batch_id, claim_id, tpa, table_name, cast(row_number() over (partition by claim_id, tpa, table_name order by c.n) - 1 as int) as step,
 c.rule_id as rule_id, c.target_column as target_column, cast(c.before as varchar) as before, cast(c.after as varchar) as after,
 not list_contains(failed, c.rule_id) as mended
from s where c.x""")
def correction_audit(spark, d):
    return ru.correction_audit(_mended(spark, d), "C1", RULES_AS_OF, id_col="claim_id", table_col="table_name").drop("corrected_timestamp")


@register("standardize_names", oracle="""
select c_custkey, concat(upper(left(trim(c_name), 1)), lower(substr(trim(c_name), 2))) as c_name,
 lower(trim(c_mktsegment)) as c_mktsegment from customer""")
def standardize_names(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return ru.standardize(c, {"c_name": "INITCAP", "c_mktsegment": "LOWER"})


@register("standardize_dates", oracle="""
select o_orderkey, cast(o_orderdate as date) as order_date from orders""")
def standardize_dates(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_date"))
    return ru.standardize(o, {"order_date": "DATE"})


@register("dedupe_exact", oracle="""
select doc_id, case when doc_id <> min(doc_id) over (partition by text) then min(doc_id) over (partition by text) end as duplicate_of
from documents""")
def dedupe_exact(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return ru.dedupe_exact(docs, ["text"], id_col="id").select(F.col("id").alias("doc_id"), "duplicate_of")


@register("ri_orphans", views=("v_claim", "v_member"), oracle="""
select claim_id, member_id from v_claim c
where not exists (select 1 from v_member m where m.tpa <> 'europe' and m.member_id = c.member_id)""")
def ri_orphans(spark, d):
    ref = b.members(spark, d).filter(F.col("tpa") != "europe").select("member_id")
    _ok, orphans = ru.ri_check(b.claims(spark, d).select("claim_id", "member_id"), ref, ["member_id"])
    return orphans
