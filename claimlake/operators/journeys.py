"""Member journeys: metrics refresh, reports, timeline, bulk close, event append.

Event-side work is always pre-aggregated per journey before it meets the
journey table, so joins never fan out over events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlake.functions.dates import as_date
from claimlake.functions.text import ratio


def event_rollup(events: DataFrame, journey_id: str | None = None) -> DataFrame:
    e = events if journey_id is None else events.filter(F.col("journey_id") == journey_id)
    return e.groupBy("journey_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("cost").cast("decimal(18,2)").alias("total_event_cost"),
        F.min("event_date").alias("first_event"),
        F.max("event_date").alias("last_event"),
        F.countDistinct("provider_id").alias("provider_count"))


def update_journey_metrics(journeys: DataFrame, events: DataFrame, journey_id: str | None = None) -> DataFrame:
    """JRN-1: visits, cost and providers from events; journeys without events keep their values."""
    r = event_rollup(events, journey_id)
    j = journeys.join(r, "journey_id", "left")
    hit = F.col("event_count").isNotNull()
    out = []
    for c in journeys.columns:
        if c == "num_visits":
            out.append(F.when(hit, F.col("event_count")).otherwise(F.col(c)).alias(c))
        elif c == "total_cost":
            out.append(F.when(hit, F.col("total_event_cost")).otherwise(F.col(c)).cast("decimal(18,2)").alias(c))
        elif c == "num_providers":
            out.append(F.when(hit, F.col("provider_count")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def active_journeys(journeys: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """JRN-2: active journeys with days open, event count, last event."""
    r = events.groupBy("journey_id").agg(F.count("event_id").alias("total_events"),
                                         F.max("event_date").alias("last_event_date"))
    j = journeys.filter(F.col("is_active"))
    return (j.join(r, "journey_id", "left")
             .select("journey_id", "member_id", "tpa", "journey_type", "start_date", "total_cost",
                     "num_visits", "num_providers",
                     F.datediff(as_date(as_of), F.col("start_date")).cast("bigint").alias("days_in_journey"),
                     F.coalesce("total_events", F.lit(0)).alias("total_events"), "last_event_date"))


def _avg(c) -> F.Column:
    """Exact-sum average: sum in the column's own type, one division in double."""
    return ratio(F.sum(c), F.count(c))


def journey_summary(journeys: DataFrame) -> DataFrame:
    """JRN-3/JRN-8: per tpa and journey type."""
    closed = F.when(F.col("end_date").isNotNull(), F.datediff("end_date", "start_date"))
    return journeys.groupBy("tpa", "journey_type").agg(
        F.count(F.lit(1)).alias("total_journeys"),
        F.count_if(F.col("is_active")).alias("active_journeys"),
        F.count_if(~F.col("is_active")).alias("completed_journeys"),
        _avg("total_cost").alias("avg_cost"),
        _avg("num_visits").alias("avg_visits"),
        _avg("num_providers").alias("avg_providers"),
        ratio(F.sum(closed), F.count(closed)).alias("avg_duration_days"),
        _avg("quality_score").alias("avg_quality_score"),
        _avg("patient_satisfaction").alias("avg_satisfaction"))


def high_cost(journeys: DataFrame, events: DataFrame, as_of, threshold=10000) -> DataFrame:
    """JRN-4: journeys above the cost threshold (filter before the join)."""
    j = journeys.filter(F.col("total_cost") > threshold)
    r = events.groupBy("journey_id").agg(F.count("event_id").alias("total_events"))
    return (j.join(r, "journey_id", "left")
             .select("journey_id", "member_id", "tpa", "journey_type", "start_date", "total_cost",
                     "num_visits", "num_providers",
                     F.datediff(F.coalesce("end_date", as_date(as_of)), F.col("start_date")).cast("bigint")
                      .alias("duration_days"),
                     ratio("total_cost", "num_visits").alias("cost_per_visit"),
                     F.coalesce("total_events", F.lit(0)).alias("total_events")))


def timeline(journeys: DataFrame, events: DataFrame) -> DataFrame:
    """JRN-5: events of each journey with days from start and a sequence number.

    The sequence is ``events on earlier days`` + ``position within the day``
    (ties on a day broken by event id).  The first term comes from a window
    over distinct (journey, day) counts and the second from a window per
    (journey, day), so a journey with a huge number of events is spread over
    its days instead of landing in one task.
    """
    j = journeys.select("journey_id", "member_id", "tpa", "journey_type", "start_date")
    per_day = events.groupBy("journey_id", "event_date").agg(F.count(F.lit(1)).alias("_n"))
    wd = Window.partitionBy("journey_id").orderBy("event_date").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.withColumn("_before", F.coalesce(F.sum("_n").over(wd), F.lit(0))).drop("_n")
    wi = Window.partitionBy("journey_id", "event_date").orderBy("event_seq")
    e = (events.drop("member_id").withColumn("_pos", F.row_number().over(wi))
               .join(per_day, ["journey_id", "event_date"]))
    return (j.join(e, "journey_id")
             .select("journey_id", "member_id", "tpa", "journey_type", "event_id", "event_date", "event_type",
                     "provider_id", "cost",
                     F.datediff("event_date", "start_date").cast("bigint").alias("days_from_start"),
                     (F.col("_before") + F.col("_pos")).cast("bigint").alias("event_sequence")))


def close_journeys(journeys: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """JRN-6: bulk close; ``changes`` has journey_id and optional end_date,
    quality_score, patient_satisfaction."""
    ch = changes.select("journey_id",
                        *[F.col(c).alias(f"_c_{c}") for c in ("end_date", "quality_score", "patient_satisfaction")
                          if c in changes.columns],
                        F.lit(True).alias("_hit"))
    for c in ("end_date", "quality_score", "patient_satisfaction"):
        if f"_c_{c}" not in ch.columns:
            ch = ch.withColumn(f"_c_{c}", F.lit(None))
    j = journeys.join(ch, "journey_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = []
    for c in journeys.columns:
        if c == "end_date":
            out.append(F.when(hit, F.coalesce("_c_end_date", as_date(as_of))).otherwise(F.col(c)).alias(c))
        elif c == "is_active":
            out.append(F.when(hit, F.lit(False)).otherwise(F.col(c)).alias(c))
        elif c == "current_stage":
            out.append(F.when(hit, F.lit("COMPLETED")).otherwise(F.col(c)).alias(c))
        elif c in ("quality_score", "patient_satisfaction"):
            out.append(F.when(hit, F.col(f"_c_{c}").cast(journeys.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def event_id_for(*cols) -> F.Column:
    """Deterministic event id (hash of the event's content), never random."""
    return F.concat(F.lit("EVT"), F.lpad(F.hex(F.xxhash64(*cols)), 16, "0"))


def add_events(journeys: DataFrame, events: DataFrame, new_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JRN-7: append events, then refresh only the touched journeys."""
    all_events = events.unionByName(new_events, allowMissingColumns=True)
    touched = new_events.select("journey_id").distinct()
    touched_events = all_events.join(touched, "journey_id", "left_semi")
    return update_journey_metrics(journeys, touched_events), all_events


def event_stats(events: DataFrame) -> DataFrame:
    """JRN-9: per event type count and average cost."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                            _avg("cost").alias("avg_cost"))


def active_by_tpa(journeys: DataFrame) -> DataFrame:
    """JRN-10."""
    return (journeys.filter(F.col("is_active")).groupBy("tpa")
                    .agg(F.count(F.lit(1)).alias("active_journeys"),
                         F.sum("total_cost").cast("decimal(28,2)").alias("total_cost"),
                         _avg("num_visits").alias("avg_visits")))


def top_costly(journeys: DataFrame, as_of, threshold=5000, n: int = 10) -> DataFrame:
    """JRN-11: the n costliest journeys above the threshold (ties by id)."""
    return (journeys.filter(F.col("total_cost") > threshold)
                    .select("journey_id", "member_id", "tpa", "journey_type", "total_cost", "num_visits",
                            F.datediff(F.coalesce("end_date", as_date(as_of)), F.col("start_date")).cast("bigint")
                             .alias("duration_days"))
                    .orderBy(F.col("total_cost").desc(), F.col("journey_id"))
                    .limit(n))


def timeline_of(journeys: DataFrame, events: DataFrame, journey_id: str | None = None) -> DataFrame:
    """JRN-12: timeline of one journey; default the smallest journey id."""
    if journey_id is None:
        pick = journeys.agg(F.min("journey_id").alias("journey_id"))
        j = journeys.join(pick, "journey_id", "left_semi")
    else:
        j = journeys.filter(F.col("journey_id") == journey_id)
    e = events.join(j.select("journey_id"), "journey_id", "left_semi")
    return timeline(j, e)
