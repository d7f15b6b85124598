"""Registered gold plans (GLD-*) over the driver bindings."""

from __future__ import annotations

from claimlake.operators import gold
from claimlake.plans import bindings as b
from claimlake.plans.registry import register

RISK_CUTS = (5_000_000, 2_500_000, 1_000_000, 500_000)


@register("claims_analytics", views=("v_claim", "v_provider"), oracle="""
select g.*, p.specialty as provider_specialty,
 cast(total_paid as double) / nullif(cast(claim_count as double), 0) as avg_paid_per_claim,
 cast(total_paid as double) / nullif(cast(unique_members as double), 0) as avg_paid_per_member,
 cast(total_billed as double) / nullif(cast(claim_count as double), 0) as avg_billed_per_claim,
 cast(total_billed - total_paid as double) / nullif(cast(total_billed as double), 0) as discount_rate
from (select tpa, cast(year(service_date) as int) as claim_year, cast(month(service_date) as int) as claim_month,
        claim_type, provider_id, count(*) as claim_count, count(distinct member_id) as unique_members,
        cast(sum(billed_amount) as decimal(28,2)) as total_billed, cast(sum(allowed_amount) as decimal(28,2)) as total_allowed,
        cast(sum(paid_amount) as decimal(28,2)) as total_paid
      from v_claim group by 1,2,3,4,5) g
left join v_provider p on g.provider_id = p.provider_id""")
def claims_analytics(spark, d):
    return gold.claims_analytics(b.claims(spark, d), b.providers(spark, d))


@register("member_360", views=("v_claim", "v_member", "v_provider"), oracle="""
with base as (
 select member_id, count(*) as total_claims, cast(sum(paid_amount) as decimal(28,2)) as total_paid,
  cast(sum(billed_amount) as decimal(28,2)) as total_billed,
  count(*) filter (where claim_type='MEDICAL') as medical_claims,
  count(*) filter (where claim_type='DENTAL') as dental_claims,
  count(*) filter (where claim_type='PHARMACY') as pharmacy_claims,
  count(*) filter (where year(service_date) = 2001) as total_claims_ytd,
  cast(coalesce(sum(case when year(service_date) = 2001 then paid_amount end), 0) as decimal(28,2)) as total_paid_ytd,
  max(service_date) as last_visit_date
 from v_claim group by member_id),
pcp as (
 select member_id, arg_max(provider_id, n * 1000000000000 - provider_id) as pcp_id
 from (select member_id, provider_id, count(*) as n from v_claim group by 1,2) group by member_id),
chronic as (
 select member_id, string_agg(diagnosis_code, ',' order by diagnosis_code) as chronic_conditions
 from (select member_id, diagnosis_code, count(*) as n from v_claim group by 1,2) where n >= 2 group by member_id)
select m.member_id, m.tpa, m.member_name, m.date_of_birth, cast(2001 - year(m.date_of_birth) as bigint) as age,
 m.gender, m.enrollment_date, m.is_active,
 coalesce(total_claims, 0) as total_claims, coalesce(total_paid, 0) as total_paid,
 coalesce(medical_claims, 0) as medical_claims, coalesce(dental_claims, 0) as dental_claims,
 coalesce(pharmacy_claims, 0) as pharmacy_claims, coalesce(total_claims_ytd, 0) as total_claims_ytd,
 coalesce(total_paid_ytd, 0) as total_paid_ytd,
 cast(total_billed as double) / nullif(cast(total_claims as double), 0) as avg_billed_per_claim,
 last_visit_date, coalesce(chronic_conditions, '') as chronic_conditions,
 pcp.pcp_id as primary_care_provider_id, p.provider_name as primary_care_provider,
 cast(case when coalesce(total_paid,0) > 5000000 then 5 when coalesce(total_paid,0) > 2500000 then 4
   when coalesce(total_paid,0) > 1000000 then 3 when coalesce(total_paid,0) > 500000 then 2 else 1 end as int) as risk_score
from v_member m left join base using (member_id) left join pcp using (member_id) left join chronic using (member_id)
left join v_provider p on pcp.pcp_id = p.provider_id""")
def member_360(spark, d):
    from pyspark.sql import functions as F
    df = gold.member_360(b.claims(spark, d), b.members(spark, d), b.providers(spark, d),
                         b.CLAIMS_AS_OF, RISK_CUTS)
    # Arrays are compared as their comma-joined text.
    return df.withColumn("chronic_conditions", F.array_join("chronic_conditions", ","))


@register("provider_performance", views=("v_claim", "v_provider"), oracle="""
with g as (
 select tpa, provider_id, concat(year(service_date), '-Q', quarter(service_date)) as measurement_period,
  count(distinct member_id) as unique_members, count(*) as total_claims,
  cast(sum(paid_amount) as decimal(28,2)) as total_paid, cast(sum(billed_amount) as decimal(28,2)) as total_billed
 from v_claim group by 1,2,3),
r as (
 -- a visit counts when the same member's visit of this tenant and provider before it lies 1 to 30 days back
 select tpa, provider_id, concat(year(service_date), '-Q', quarter(service_date)) as measurement_period, count(*) as readmits
 from (select distinct tpa, provider_id, member_id, service_date from v_claim) v
 where exists (select 1 from v_claim e where e.tpa = v.tpa and e.provider_id = v.provider_id and e.member_id = v.member_id
   and e.service_date < v.service_date and date_diff('day', e.service_date, v.service_date) <= 30)
 group by 1, 2, 3)
select g.*, cast(total_paid as double) / nullif(cast(unique_members as double), 0) as avg_cost_per_member,
 cast(total_paid as double) / nullif(cast(total_claims as double), 0) as avg_cost_per_claim,
 cast(total_billed - total_paid as double) / nullif(cast(total_billed as double), 0) as discount_rate,
 cast(coalesce(r.readmits, 0) as double) / nullif(cast(total_claims as double), 0) as readmission_rate,
 cast(null as double) as quality_score, p.provider_name, p.specialty as provider_specialty, p.provider_type
from g left join r using (tpa, provider_id, measurement_period) left join v_provider p using (provider_id)""")
def provider_performance(spark, d):
    return gold.provider_performance(b.claims(spark, d), b.providers(spark, d))


@register("readmission_rate", views=("v_claim",), oracle="""
with v as (select distinct tpa, provider_id, member_id, service_date from v_claim),
r as (select tpa, provider_id, concat(year(service_date), '-Q', quarter(service_date)) as measurement_period, count(*) as n
 from v where exists (select 1 from v e where e.tpa = v.tpa and e.provider_id = v.provider_id and e.member_id = v.member_id
  and e.service_date < v.service_date and date_diff('day', e.service_date, v.service_date) <= 30) group by 1, 2, 3),
g as (select tpa, provider_id, concat(year(service_date), '-Q', quarter(service_date)) as measurement_period,
 count(*) as total_claims from v_claim group by 1, 2, 3)
select g.*, cast(coalesce(r.n, 0) as bigint) as readmissions,
 cast(coalesce(r.n, 0) as double) / nullif(cast(total_claims as double), 0) as readmission_rate
from g left join r using (tpa, provider_id, measurement_period)""")
def readmission_rate(spark, d):
    return gold.readmission_rates(b.claims(spark, d))


@register("financial_summary", views=("v_claim",), oracle="""
select tpa, cast(year(service_date) as int) as fiscal_year, cast(month(service_date) as int) as fiscal_month,
 cast(quarter(service_date) as int) as fiscal_quarter,
 case when grouping(claim_type) = 1 then 'ALL' else claim_type end as claim_type,
 cast(sum(billed_amount) as decimal(28,2)) as total_billed, cast(sum(allowed_amount) as decimal(28,2)) as total_allowed,
 cast(sum(paid_amount) as decimal(28,2)) as total_paid,
 cast(sum(allowed_amount - paid_amount) as decimal(28,2)) as total_member_responsibility,
 count(*) as claim_count, count(distinct member_id) as member_count,
 cast(cast(sum(paid_amount) as decimal(28,2)) as double) / nullif(cast(count(distinct member_id) as double), 0) as pmpm,
 cast(cast(sum(paid_amount) as decimal(28,2)) as double) / nullif(cast(cast(sum(billed_amount) as decimal(28,2)) as double), 0) as medical_loss_ratio
from v_claim
group by grouping sets ((tpa, year(service_date), month(service_date), quarter(service_date), claim_type),
                        (tpa, year(service_date), month(service_date), quarter(service_date)))""")
def financial_summary(spark, d):
    return gold.financial_summary(b.claims(spark, d))
