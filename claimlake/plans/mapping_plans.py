"""Registered silver mapping plans (MAP-*) over data-derived metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.functions.similarity import word_jaccard
from claimlake.functions.text import norm_name
from claimlake.operators import mapping as mp
from claimlake.plans import bindings as b
from claimlake.plans.registry import register
from claimlake.session import written
from claimlake.sources.tables import table

PROMPT = "Map these source fields:\n{source_fields}\nto these target fields:\n{target_fields}\nAnswer as JSON."
M_COLS = ("mapping_id, source_field, source_table, target_table, target_column, tpa, mapping_method, confidence_score, "
          "approved, active, transformation_logic")


def norm_sql(c: str) -> str:
    return f"trim(lower(regexp_replace({c}, '[^a-zA-Z0-9]', ' ', 'g')))"


@register("schema_column_counts", views=("v_defs",), oracle="""
select table_name, count(*) as column_count from v_defs group by table_name""")
def schema_column_counts(spark, d):
    return mp.schema_columns(b.target_schemas(spark, d))


@register("default_type_check", views=("v_defs",), oracle="""
select *, case
 when default_value is null or length(trim(default_value)) = 0 then case when upper(nullable) in ('N','NO','FALSE') then 'missing_default' end
 when default_value like '%(%)%' and ((data_type = 'DATE' and upper(split_part(default_value, '(', 1)) <> 'CURRENT_DATE')
   or (data_type like 'TIMESTAMP%' and upper(split_part(default_value, '(', 1)) = 'CURRENT_DATE'))
   then concat('function_does_not_fit:', upper(split_part(default_value, '(', 1)))
 when default_value like '%(%)%' and upper(split_part(default_value, '(', 1)) in ('CURRENT_TIMESTAMP','CURRENT_DATE','CURRENT_TIME','CURRENT_USER','SYSDATE','GETDATE','UUID_STRING','SEQ') then null
 when split_part(data_type, '(', 1) in ('NUMBER','INT','INTEGER','BIGINT','DECIMAL','NUMERIC','FLOAT','DOUBLE') and not regexp_matches(replace(default_value, ',', ''), '^[+-]?(\\d+\\.?\\d*([eE][+-]?\\d+)?|\\.\\d+([eE][+-]?\\d+)?|inf|infinity|nan)$')
   and not default_value like '%(%)%' then concat('not_a_number:', default_value)
 when data_type = 'BOOLEAN' and upper(default_value) not in ('TRUE','FALSE','0','1') then concat('not_a_boolean:', default_value)
 when split_part(data_type, '(', 1) in ('DATE','TIME','TIMESTAMP','TIMESTAMP_NTZ','TIMESTAMP_LTZ','TIMESTAMP_TZ') and not default_value like '%(%)%'
   and not (default_value like '''%''') then concat('not_a_time_value:', default_value)
end as default_error
from v_defs""")
def default_type_check(spark, d):
    return mp.validate_defaults(b.target_schemas(spark, d))


@register("conform_claims")
def conform_claims(spark, d):
    """MAP-4 over the claims of every defined table (rows-only check: types come from the data).

    A column whose type differs between the tables is a string: the text of the conformed value.
    """
    structs = {}  # schema-sized: one row per defined column
    for r in b.target_schemas(spark, d).collect():
        structs.setdefault(r["table_name"], []).append(r)
    structs = {t: mp.build_struct(rows) for t, rows in sorted(structs.items())}
    types = {}
    for struct in structs.values():
        for name, t, *_ in struct:
            types.setdefault(name, set()).add(t)
    alike = {}  # tables of one structure are conformed by one pass
    for t, struct in structs.items():
        alike.setdefault(tuple(struct), []).append(t)
    src, out = b.claim_strings(spark, d), None
    if len(alike) > 1:
        src = written(src, "claim-strings")  # read by several passes: joined once
    for struct, tables in alike.items():
        one = mp.conform_to_schema(src.filter(F.col("table_name").isin(tables)), struct, as_of=b.CLAIMS_AS_OF, keep=["tpa", "table_name"])
        one = one.withColumns({name: F.col(name).cast("string") for name, *_ in struct if len(types[name]) > 1})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


@register("table_inventory", views=("v_mappings", "v_claim"), oracle="""
select c.tpa, c.table_name, coalesce(n.row_count, 0) as row_count
from (select distinct tpa, target_table as table_name from v_mappings) c
left join (select tpa, concat(claim_type, '_CLAIMS') as table_name, count(*) as row_count from v_claim group by 1, 2) n
 on c.tpa = n.tpa and c.table_name = n.table_name""")
def table_inventory(spark, d):
    created = b.field_mappings(spark, d).select("tpa", F.col("target_table").alias("table_name")).distinct()
    counts = (b.claims(spark, d).groupBy("tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("table_name"))
              .agg(F.count(F.lit(1)).alias("row_count")))
    return mp.table_inventory(created, counts)


@register("manual_mapping_upsert", views=("v_mappings",), oracle=f"""
with src as (
 select upper(trim(lower(source_field))) as source_field, 'RAW_DATA_TABLE' as source_table, target_table,
  upper(source_field) as target_column, tpa, 'MANUAL' as mapping_method, 1.0 as confidence_score, true as approved,
  transformation_logic
 from v_mappings where tpa = 'america')
select t.mapping_id, coalesce(t.source_field, s.source_field) as source_field, coalesce(t.source_table, s.source_table) as source_table,
 coalesce(t.target_table, s.target_table) as target_table, coalesce(t.target_column, s.target_column) as target_column,
 coalesce(t.tpa, s.tpa) as tpa,
 case when s.tpa is not null then s.mapping_method else t.mapping_method end as mapping_method,
 case when s.tpa is not null then s.confidence_score else t.confidence_score end as confidence_score,
 case when s.tpa is not null then s.approved else t.approved end as approved,
 case when t.tpa is not null then t.active else true end as active,
 case when s.tpa is not null then s.transformation_logic else t.transformation_logic end as transformation_logic
from v_mappings t full outer join src s
 on t.source_field = s.source_field and t.source_table = s.source_table and t.target_table = s.target_table
 and t.target_column = s.target_column and t.tpa = s.tpa""")
def manual_mapping_upsert(spark, d):
    m = b.field_mappings(spark, d)
    csv = (m.filter(F.col("tpa") == "america")
            .select(F.lower("source_field").alias("source_field"), F.lit(None).cast("string").alias("source_table"),
                    "target_table", F.col("source_field").alias("target_column"), "tpa", "transformation_logic",
                    F.lit(None).cast("string").alias("description")))
    return mp.upsert_manual_mappings(m, csv)


@register("norm_names", oracle=f"""
select p_partkey, {norm_sql('p_name')} as name_norm, {norm_sql('p_brand')} as brand_norm from part""")
def norm_names(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", norm_name("p_name").alias("name_norm"), norm_name("p_brand").alias("brand_norm"))


@register("word_jaccard", oracle=f"""
with w as (select p_partkey,
  list_distinct(list_filter(string_split({norm_sql('p_name')}, ' '), lambda x: x <> '')) as a,
  list_distinct(list_filter(string_split({norm_sql("concat(p_type, ' ', p_name)")}, ' '), lambda x: x <> '')) as b
 from part)
select p_partkey, case when len(a) > 0 and len(b) > 0
  then cast(len(list_intersect(a, b)) as double) / cast(len(list_distinct(list_concat(a, b))) as double) else 0.0 end as word_overlap
from w""")
def word_jaccard_q(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", word_jaccard(norm_name("p_name"),
                                              norm_name(F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"))))
                    .alias("word_overlap"))


def _auto(spark, d, profile, min_conf=0.6):
    defs = b.target_schemas(spark, d, profile).select(F.col("table_name").alias("target_table"),
                                             F.col("column_name").alias("target_column"))
    return mp.auto_map(b.raw_source_fields(spark, d, profile), defs, 3, min_conf)


@register("auto_map_scores")
def auto_map_scores(spark, d):
    return _auto(spark, d, b.claims_profile(spark, d), 0.3)


@register("append_mappings")
def append_mappings(spark, d):
    p = b.claims_profile(spark, d)  # the claims are joined and read once for all three
    return mp.append_mappings(b.field_mappings(spark, d, p), _auto(spark, d, p, 0.6))


@register("mapping_prompts", views=("v_src_fields", "v_defs", "v_claim"), oracle="""
with src as (select tpa, string_agg(concat('- ', source_field), chr(10) order by source_field) as src_list
             from v_src_fields group by tpa),
tgt as (select table_name, string_agg(concat('- ', table_name, '.', column_name,
          case when coalesce(length(description), 0) > 0 then concat(' (', description, ')') else '' end),
          chr(10) order by column_name) as tgt_list from v_defs group by table_name),
asks as (select distinct tpa, concat(claim_type, '_CLAIMS') as target_table from v_claim)
select a.tpa, a.target_table,
 replace(replace('Map these source fields:' || chr(10) || '{source_fields}' || chr(10) || 'to these target fields:' || chr(10)
   || '{target_fields}' || chr(10) || 'Answer as JSON.', '{source_fields}', src.src_list), '{target_fields}', tgt.tgt_list) as prompt
from asks a join src on a.tpa = src.tpa join tgt on a.target_table = tgt.table_name""")
def mapping_prompts(spark, d):
    p = b.claims_profile(spark, d)
    asks = p.select("tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("target_table"))
    return mp.mapping_prompts(b.raw_source_fields(spark, d, p), b.target_schemas(spark, d, p), PROMPT, asks)


@register("parse_responses", views=("v_mappings",), oracle="""
select tpa, target_table, cast(row_number() over (partition by tpa, target_table order by source_field) - 1 as int) as item_no, source_field,
 concat(target_table, '.', target_column) as target_field, confidence_score as confidence, cast(null as varchar) as reasoning from v_mappings""")
def parse_responses(spark, d):
    """Responses written per (tenant, table) in three styles, parsed and validated."""
    m = b.field_mappings(spark, d)
    item = F.to_json(F.struct(F.col("source_field"), F.concat(F.col("target_table"), F.lit("."),
                                                              F.col("target_column")).alias("target_field"),
                              F.col("confidence_score").alias("confidence")))
    g = m.groupBy("tpa", "target_table").agg(F.array_join(F.array_sort(F.collect_list(item)), ",").alias("items"))
    body = F.concat(F.lit("["), F.col("items"), F.lit("]"))
    resp = (F.when(F.col("tpa") == "asia", body)
             .when(F.col("tpa") == "europe", F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```")))
             .otherwise(F.concat(F.lit("mappings: "), F.col("items"))))
    parsed = mp.parse_responses(g.select("tpa", "target_table", resp.alias("response")))
    return parsed


@register("approve_mappings", views=("v_mappings",), oracle=f"""
select mapping_id, source_field, source_table, target_table, target_column, tpa, mapping_method, confidence_score,
 case when target_table = 'DENTAL_CLAIMS' and confidence_score >= 0.8 and not coalesce(approved, false) then true else approved end as approved,
 active, transformation_logic
from v_mappings""")
def approve_mappings(spark, d):
    return mp.approve_mappings(b.field_mappings(spark, d), "DENTAL_CLAIMS", 0.8)


@register("approved_mappings", views=("v_mappings",), oracle=f"""
select {M_COLS} from v_mappings where approved and coalesce(active, true)""")
def approved_mappings(spark, d):
    return mp.approved_mappings(b.field_mappings(spark, d))


@register("field_mapping_summary", views=("v_mappings",), oracle="""
select mapping_method, approved, count(*) as mapping_count,
 sum(confidence_score) / count(confidence_score) as avg_confidence,
 min(confidence_score) as min_confidence, max(confidence_score) as max_confidence
from v_mappings group by 1, 2""")
def field_mapping_summary(spark, d):
    return mp.mapping_summary(b.field_mappings(spark, d))


@register("duplicate_target_mappings", views=("v_mappings",), oracle="""
select tpa, target_table, target_column, count(*) as mapping_count,
 string_agg(source_field, ', ' order by source_field) as source_fields
from v_mappings group by 1, 2, 3 having count(*) > 1""")
def duplicate_target_mappings(spark, d):
    return mp.duplicate_targets(b.field_mappings(spark, d))


@register("unmapped_target_fields", views=("v_defs", "v_mappings"), oracle="""
select * from v_defs d where not exists (select 1 from v_mappings m where m.target_table = d.table_name
 and m.target_column = d.column_name)""")
def unmapped_target_fields(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    return mp.unmapped_targets(b.target_schemas(spark, d, p), b.field_mappings(spark, d, p))


@register("validate_mappings", views=("v_defs", "v_mappings"), oracle="""
select 'DUPLICATE_TARGET' as issue_type, tpa, target_table, target_column,
 concat('Target mapped ', count(*), ' times') as detail
from v_mappings where target_table like '%CLAIMS' group by 2, 3, 4 having count(*) > 1
union all
select 'ORPHAN_TARGET', tpa, target_table, target_column, concat('Source ', source_field, ' maps to an undefined column')
from v_mappings m where target_table like '%CLAIMS'
 and not exists (select 1 from v_defs d where d.table_name = m.target_table and d.column_name = m.target_column)
union all
select 'INVALID_METHOD', tpa, target_table, target_column, concat('Unknown method ', coalesce(mapping_method, 'NULL'))
from v_mappings where target_table like '%CLAIMS'
 and not coalesce(mapping_method in ('MANUAL','ML_AUTO','LLM_CORTEX','SYSTEM'), false)""")
def validate_mappings(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    return mp.validate_mappings(b.field_mappings(spark, d, p), b.target_schemas(spark, d, p), "%CLAIMS")


@register("mapping_conformance", views=("v_defs", "v_mappings"), oracle=f"""
select {M_COLS},
 case when not exists (select 1 from v_defs d where upper(d.table_name) = m.target_table and upper(d.column_name) = m.target_column)
  then concat('Column ', target_column, ' does not exist in ', target_table) end as error,
 case when count(*) over (partition by tpa, target_table, target_column) > 1
  then concat('Target column used by ', count(*) over (partition by tpa, target_table, target_column), ' mappings') end as warning
from v_mappings m""")
def mapping_conformance(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    defs = b.target_schemas(spark, d, p).select("table_name", "column_name")
    return mp.conformance(b.field_mappings(spark, d, p), defs)


NEW_SQL = """
select tpa, target_table, unnest(['CLAIM_ID', 'SVC_DATE', 'PROCESSED_DATE']) as target_column,
 unnest(['CLAIM_REF', 'SVC_DT', 'PROC_TS']) as source_field
from (select distinct tpa, concat(claim_type, '_CLAIMS') as target_table from v_claim)"""


@register("new_mapping_errors", views=("v_claim", "v_mappings", "v_defs"), oracle=f"""
with n as ({NEW_SQL})
select n.tpa, n.target_table, n.target_column, n.source_field,
 case when not exists (select 1 from v_defs d where upper(d.table_name) = n.target_table and upper(d.column_name) = n.target_column)
   then 'target column does not exist'
  when exists (select 1 from v_mappings m where m.tpa = n.tpa and m.target_table = n.target_table and m.target_column = n.target_column)
   then 'target column already mapped' end as error
from n""")
def new_mapping_errors(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    asks = p.select("tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("target_table")).distinct()
    pairs = F.arrays_zip(F.array(F.lit("CLAIM_ID"), F.lit("SVC_DATE"), F.lit("PROCESSED_DATE")).alias("target_column"),
                         F.array(F.lit("CLAIM_REF"), F.lit("SVC_DT"), F.lit("PROC_TS")).alias("source_field"))
    new = asks.select("tpa", "target_table", F.inline(pairs))
    defs = b.target_schemas(spark, d, p).select("table_name", "column_name")
    return mp.new_mapping_errors(new, b.field_mappings(spark, d, p), defs)


@register("column_list", views=("v_defs",), oracle="""
select table_name, string_agg(distinct column_name, ', ' order by column_name) as columns from v_defs group by table_name""")
def column_list(spark, d):
    return mp.column_list(b.target_schemas(spark, d))


@register("schema_drift", views=("v_defs", "v_mappings"), oracle="""
with ex as (select distinct tpa, target_table as table_name, target_column as column_name from v_mappings),
req as (select t.tpa, d.table_name, d.column_name from (select distinct tpa, table_name from ex) t
        join v_defs d on d.table_name = t.table_name),
j as (select r.*, e.column_name is not null as ok from req r left join ex e
      on r.tpa = e.tpa and r.table_name = e.table_name and r.column_name = e.column_name)
select tpa, table_name, count(*) as required_columns, count(*) filter (where ok) as present_columns,
 coalesce(string_agg(case when not ok then column_name end, ', ' order by case when not ok then column_name end), '') as missing_columns,
 case when count(*) filter (where ok) = count(*) then 'PASS' else 'FAIL' end as status
from j group by tpa, table_name""")
def schema_drift(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    m = b.field_mappings(spark, d, p)
    existing = m.select("tpa", F.col("target_table").alias("table_name"), F.col("target_column").alias("column_name"))
    required = b.target_schemas(spark, d, p).select("table_name", "column_name")
    return mp.drift_check(required, existing)


@register("mapping_duplicate_flags", views=("v_mappings",), oracle=f"""
select {M_COLS}, count(*) over (partition by tpa, source_field, target_table) as source_uses,
 count(*) over (partition by tpa, target_table, target_column) as target_uses,
 count(*) over (partition by tpa, source_field, target_table) > 1 as one_to_many,
 count(*) over (partition by tpa, target_table, target_column) > 1 as many_to_one
from v_mappings""")
def mapping_duplicate_flags(spark, d):
    return mp.flag_duplicates(b.field_mappings(spark, d))


@register("mapping_kpis", views=("v_defs", "v_mappings"), oracle="""
with a as (select target_table as table_name, count(*) as total_mappings, count(*) filter (where approved) as approved_mappings,
             count(*) filter (where not approved) as pending_mappings from v_mappings group by 1)
select t.table_name, coalesce(total_mappings, 0) as total_mappings, coalesce(approved_mappings, 0) as approved_mappings,
 coalesce(pending_mappings, 0) as pending_mappings,
 case when total_mappings > 0 then cast(approved_mappings as double) * 100 / cast(total_mappings as double) end as approval_rate,
 coalesce(total_mappings, 0) > 0 as has_mappings
from (select distinct table_name from v_defs) t left join a on t.table_name = a.table_name""")
def mapping_kpis(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    return mp.mapping_kpis(b.field_mappings(spark, d, p), b.target_schemas(spark, d, p))


@register("drop_table_counts", views=("v_defs", "v_mappings", "v_claim"), oracle="""
select 'definitions' as object, count(*) filter (where table_name = 'DENTAL_CLAIMS') as removed from v_defs
union all select 'mappings', count(*) filter (where target_table = 'DENTAL_CLAIMS' and tpa = 'asia') from v_mappings
union all select 'rules', count(*) filter (where target_table = 'DENTAL_CLAIMS' and tpa = 'asia') * 9
 from (select distinct tpa, concat(claim_type, '_CLAIMS') as target_table from v_claim)""")
def drop_table_counts(spark, d):
    p = b.claims_profile(spark, d, keys=False)
    return mp.drop_table_counts(b.target_schemas(spark, d, p), b.field_mappings(spark, d, p), b.silver_rules(spark, d, p),
                                "DENTAL_CLAIMS", "asia")
