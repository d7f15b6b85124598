"""Registered plans for sources/sinks and similarity (SRC-8/9, SNK-2, MAP-12, RUL-4 fuzzy)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from claimlake.operators import mapping as mp
from claimlake.operators import merge as mg
from claimlake.operators import rules as ru
from claimlake.plans import bindings as b
from claimlake.plans.registry import register
from claimlake.sources.landing import to_raw
from claimlake.sources.tables import table


@register("raw_from_columns", oracle="""
select row_number() over (order by o_orderkey) as row_number,
 json_object('O_ORDERKEY', cast(o_orderkey as varchar), 'O_ORDERSTATUS', o_orderstatus,
             'O_ORDERPRIORITY', o_orderpriority) as raw_data
from orders""")
def raw_from_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return to_raw(o, ["o_orderkey"])


@register("try_casts", oracle="""
select l_orderkey, l_linenumber, l_partkey,
 try_cast(cast(l_quantity * 100 as varchar) as decimal(5,2)) as qty_5_2,
 try_cast(l_returnflag as date) as flag_as_date,
 try_cast(strftime(l_shipdate, '%Y-%m-%d') as date) as ship_date
from lineitem""")
def try_casts(spark, d):
    l = table(spark, d, "lineitem")
    return l.select("l_orderkey", "l_linenumber", "l_partkey",
                    (F.col("l_quantity") * 100).cast("string").try_cast("decimal(5,2)").alias("qty_5_2"),
                    F.col("l_returnflag").try_cast("date").alias("flag_as_date"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").try_cast("date").alias("ship_date"))


@register("merge_upsert_claims", views=("v_claim",), oracle="""
with t as (select claim_id, tpa, claim_status, paid_amount from v_claim where received_date < date '1998-01-01'),
s as (select claim_id, tpa, 'ADJUSTED' as claim_status, cast(paid_amount * 0.5 as decimal(18,2)) as paid_amount
      from v_claim where received_date >= date '1997-01-01')
select coalesce(t.claim_id, s.claim_id) as claim_id,
 case when t.claim_id is not null and s.claim_id is not null then s.tpa when t.claim_id is not null then t.tpa else s.tpa end as tpa,
 case when s.claim_id is not null then s.claim_status else t.claim_status end as claim_status,
 case when s.claim_id is not null then s.paid_amount else t.paid_amount end as paid_amount
from t full outer join s on t.claim_id = s.claim_id""")
def merge_upsert_claims(spark, d):
    c = b.claims(spark, d)
    t = c.filter(F.col("received_date") < F.lit(_dt.date(1998, 1, 1))).select("claim_id", "tpa", "claim_status",
                                                                              "paid_amount")
    s = c.filter(F.col("received_date") >= F.lit(_dt.date(1997, 1, 1))).select(
        "claim_id", "tpa", F.lit("ADJUSTED").alias("claim_status"),
        (F.col("paid_amount") * F.lit(0.5)).cast("decimal(18,2)").alias("paid_amount"))
    return mg.merge_upsert(t, s, ["claim_id"])


@register("tfidf_pairs")
def tfidf_pairs(spark, d):
    """MAP-12: TF-IDF cosine of raw source fields against the derived definitions."""
    p = b.claims_profile(spark, d)  # the claims are joined and read once for both name lists
    defs = b.target_schemas(spark, d, p).select(F.col("table_name").alias("target_table"),
                                                F.col("column_name").alias("target_column"))
    return mp.tfidf_scores(b.raw_source_fields(spark, d, p), defs)


@register("dedupe_fuzzy", oracle=r"""
with w as (select doc_id, lang, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')) as s from documents),
p as (select b.doc_id, min(a.doc_id) as duplicate_of from w a join w b on a.lang is not distinct from b.lang and a.doc_id < b.doc_id
      where len(a.s) > 0 and len(a.s) >= 0.8 * len(b.s) and len(b.s) >= 0.8 * len(a.s)
        and len(list_intersect(a.s, b.s)) >= 0.8 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) group by b.doc_id)
select w.doc_id, w.lang, p.duplicate_of from w left join p on w.doc_id = p.doc_id""")
def dedupe_fuzzy(spark, d):
    """RUL-4 fuzzy: documents per language, word-set Jaccard >= 0.8."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return ru.fuzzy_dedupe(docs, "doc_id", "text", 0.8, "lang")
