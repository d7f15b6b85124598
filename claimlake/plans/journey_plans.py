"""Registered member-journey plans (JRN-*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from claimlake.operators import journeys as jr
from claimlake.plans import bindings as b
from claimlake.plans.registry import register

AS_OF = b.EVENTS_AS_OF.date()
HIGH_COST = 1000
COSTLY = 500
SPLIT = _dt.date(2024, 1, 20)

J_COLS = ("journey_id, member_id, tpa, journey_type, start_date, end_date, is_active, total_cost, num_visits, "
          "num_providers, current_stage, quality_score, patient_satisfaction")


@register("journey_metrics", views=("v_journey", "v_event"), oracle=f"""
with r as (select journey_id, count(*) as event_count, cast(sum(cost) as decimal(18,2)) as total_event_cost,
             count(distinct provider_id) as provider_count from v_event group by journey_id)
select j.journey_id, member_id, tpa, journey_type, start_date, end_date, is_active,
 cast(case when r.journey_id is not null then r.total_event_cost else j.total_cost end as decimal(18,2)) as total_cost,
 case when r.journey_id is not null then r.event_count else j.num_visits end as num_visits,
 case when r.journey_id is not null then r.provider_count else j.num_providers end as num_providers,
 current_stage, quality_score, patient_satisfaction
from v_journey j left join r on j.journey_id = r.journey_id""")
def journey_metrics(spark, d):
    return jr.update_journey_metrics(b.journeys(spark, d), b.events(spark, d))


@register("active_journeys", views=("v_journey", "v_event"), oracle="""
select j.journey_id, j.member_id, j.tpa, j.journey_type, j.start_date, j.total_cost, j.num_visits, j.num_providers,
 cast(date_diff('day', j.start_date, date '2024-01-31') as bigint) as days_in_journey,
 count(e.event_id) as total_events, max(e.event_date) as last_event_date
from v_journey j left join v_event e on j.journey_id = e.journey_id
where j.is_active
group by j.journey_id, j.member_id, j.tpa, j.journey_type, j.start_date, j.total_cost, j.num_visits, j.num_providers""")
def active_journeys(spark, d):
    return jr.active_journeys(b.journeys(spark, d), b.events(spark, d), AS_OF)


@register("journey_summary_by_type", views=("v_journey",), oracle="""
select tpa, journey_type, count(*) as total_journeys,
 count(*) filter (where is_active) as active_journeys, count(*) filter (where not is_active) as completed_journeys,
 cast(sum(total_cost) as double) / nullif(cast(count(total_cost) as double), 0) as avg_cost,
 cast(sum(num_visits) as double) / nullif(cast(count(num_visits) as double), 0) as avg_visits,
 cast(sum(num_providers) as double) / nullif(cast(count(num_providers) as double), 0) as avg_providers,
 cast(sum(case when end_date is not null then date_diff('day', start_date, end_date) end) as double)
   / nullif(cast(count(case when end_date is not null then 1 end) as double), 0) as avg_duration_days,
 cast(sum(quality_score) as double) / nullif(cast(count(quality_score) as double), 0) as avg_quality_score,
 cast(sum(patient_satisfaction) as double) / nullif(cast(count(patient_satisfaction) as double), 0) as avg_satisfaction
from v_journey group by tpa, journey_type""")
def journey_summary_by_type(spark, d):
    return jr.journey_summary(b.journeys(spark, d))


@register("high_cost_journeys", views=("v_journey", "v_event"), oracle=f"""
select j.journey_id, j.member_id, j.tpa, j.journey_type, j.start_date, j.total_cost, j.num_visits, j.num_providers,
 cast(date_diff('day', j.start_date, coalesce(j.end_date, date '2024-01-31')) as bigint) as duration_days,
 cast(j.total_cost as double) / nullif(cast(j.num_visits as double), 0) as cost_per_visit,
 count(e.event_id) as total_events
from v_journey j left join v_event e on j.journey_id = e.journey_id
where j.total_cost > {HIGH_COST}
group by j.journey_id, j.member_id, j.tpa, j.journey_type, j.start_date, j.total_cost, j.num_visits, j.num_providers, j.end_date""")
def high_cost_journeys(spark, d):
    return jr.high_cost(b.journeys(spark, d), b.events(spark, d), AS_OF, HIGH_COST)


TIMELINE_SQL = """
select j.journey_id, j.member_id, j.tpa, j.journey_type, e.event_id, e.event_date, e.event_type, e.provider_id, e.cost,
 cast(date_diff('day', j.start_date, e.event_date) as bigint) as days_from_start,
 row_number() over (partition by j.journey_id order by e.event_date, e.event_seq) as event_sequence
from {j} j join v_event e on j.journey_id = e.journey_id"""


@register("journey_event_timeline", views=("v_journey", "v_event"), oracle=TIMELINE_SQL.format(j="v_journey"))
def journey_event_timeline(spark, d):
    return jr.timeline(b.journeys(spark, d), b.events(spark, d))


@register("close_journeys", views=("v_journey",), oracle=f"""
with ch as (select journey_id, 4 as quality_score from v_journey where journey_type = 'error' and is_active)
select j.journey_id, member_id, tpa, journey_type, start_date,
 case when ch.journey_id is not null then date '2024-01-31' else end_date end as end_date,
 case when ch.journey_id is not null then false else is_active end as is_active,
 total_cost, num_visits, num_providers,
 case when ch.journey_id is not null then 'COMPLETED' else current_stage end as current_stage,
 case when ch.journey_id is not null then ch.quality_score else j.quality_score end as quality_score,
 case when ch.journey_id is not null then null else patient_satisfaction end as patient_satisfaction
from v_journey j left join ch on j.journey_id = ch.journey_id""")
def close_journeys(spark, d):
    j = b.journeys(spark, d)
    changes = (j.filter((F.col("journey_type") == "error") & F.col("is_active"))
                .select("journey_id", F.lit(4).alias("quality_score")))
    return jr.close_journeys(j, changes, AS_OF)


@register("add_events", views=("v_event", "v_member"), oracle=f"""
with old_e as (select * from v_event where event_date < date '{SPLIT}'),
new_e as (select * from v_event where event_date >= date '{SPLIT}'),
j as (
 select e.journey_id, e.member_id, m.tpa, e.event_type as journey_type, min(e.event_date) as start_date,
  cast(sum(e.cost) as decimal(18,2)) as total_cost, count(*) as num_visits, count(distinct e.provider_id) as num_providers
 from old_e e join v_member m on e.member_id = m.member_id group by 1, 2, 3, 4),
r as (select journey_id, count(*) as event_count, cast(sum(cost) as decimal(18,2)) as total_event_cost,
        count(distinct provider_id) as provider_count
      from v_event where journey_id in (select journey_id from new_e) group by journey_id)
select j.journey_id, j.member_id, j.tpa, j.journey_type, j.start_date,
 cast(coalesce(r.total_event_cost, j.total_cost) as decimal(18,2)) as total_cost,
 coalesce(r.event_count, j.num_visits) as num_visits, coalesce(r.provider_count, j.num_providers) as num_providers
from j left join r on j.journey_id = r.journey_id""")
def add_events(spark, d):
    ev = b.events(spark, d)
    old = ev.filter(F.col("event_date") < F.lit(SPLIT))
    new = ev.filter(F.col("event_date") >= F.lit(SPLIT))
    j = b.journeys(spark, d, old).select("journey_id", "member_id", "tpa", "journey_type", "start_date",
                                         "total_cost", "num_visits", "num_providers")
    out, _ = jr.add_events(j, old, new)
    return out


@register("event_statistics", views=("v_event",), oracle="""
select event_type, count(*) as event_count, cast(sum(cost) as double) / nullif(cast(count(cost) as double), 0) as avg_cost
from v_event group by event_type""")
def event_statistics(spark, d):
    return jr.event_stats(b.events(spark, d))


@register("active_journeys_by_tpa", views=("v_journey",), oracle="""
select tpa, count(*) as active_journeys, cast(sum(total_cost) as decimal(28,2)) as total_cost,
 cast(sum(num_visits) as double) / nullif(cast(count(num_visits) as double), 0) as avg_visits
from v_journey where is_active group by tpa""")
def active_journeys_by_tpa(spark, d):
    return jr.active_by_tpa(b.journeys(spark, d))


@register("top_costly_journeys", views=("v_journey",), oracle=f"""
select journey_id, member_id, tpa, journey_type, total_cost, num_visits,
 cast(date_diff('day', start_date, coalesce(end_date, date '2024-01-31')) as bigint) as duration_days
from v_journey where total_cost > {COSTLY} order by total_cost desc, journey_id limit 10""")
def top_costly_journeys(spark, d):
    return jr.top_costly(b.journeys(spark, d), AS_OF, COSTLY, 10)


@register("one_journey_timeline", views=("v_journey", "v_event"),
          oracle=TIMELINE_SQL.format(j="(select * from v_journey where journey_id = (select min(journey_id) from v_journey))"))
def one_journey_timeline(spark, d):
    return jr.timeline_of(b.journeys(spark, d), b.events(spark, d))
