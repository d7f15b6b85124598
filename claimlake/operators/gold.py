"""Gold analytics: claims analytics, member 360, provider performance,
financial summary, and the column formulas they share.

Every aggregate runs as one ``groupBy`` with map-side partial aggregation;
dimension tables join *after* the aggregation, so the fact side is shuffled
once on its grouping keys and the joins only see grouped rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.functions.dates import age_years, as_date
from claimlake.functions.text import ratio

MONEY = "decimal(28,2)"

# Risk score cut points on total paid (reference values: 50k/25k/10k/5k).
# The driver tables carry larger amounts, so the registered plans pass scaled cuts.
DEFAULT_RISK_CUTS = (50000, 25000, 10000, 5000)


def money_sum(c: str) -> Column:
    return F.sum(F.col(c)).cast(MONEY)


def discount_rate(billed, paid) -> Column:
    """(billed - paid) / NULLIF(billed, 0)."""
    b = F.col(billed) if isinstance(billed, str) else billed
    p = F.col(paid) if isinstance(paid, str) else paid
    return ratio(b - p, b)


def risk_score(paid, cuts=DEFAULT_RISK_CUTS) -> Column:
    p = F.col(paid) if isinstance(paid, str) else paid
    c5, c4, c3, c2 = cuts
    return (F.when(p > c5, 5).when(p > c4, 4).when(p > c3, 3).when(p > c2, 2).otherwise(1)).cast("int")


def claims_analytics(claims: DataFrame, providers: DataFrame | None = None) -> DataFrame:
    """GLD-2/3/4: per tpa, year, month, claim type and provider."""
    g = (claims.groupBy("tpa", F.year("service_date").alias("claim_year"),
                        F.month("service_date").alias("claim_month"), "claim_type", "provider_id")
               .agg(F.count(F.lit(1)).alias("claim_count"),
                    F.countDistinct("member_id").alias("unique_members"),
                    money_sum("billed_amount").alias("total_billed"),
                    money_sum("allowed_amount").alias("total_allowed"),
                    money_sum("paid_amount").alias("total_paid")))
    g = g.select("*",
                 ratio("total_paid", "claim_count").alias("avg_paid_per_claim"),
                 ratio("total_paid", "unique_members").alias("avg_paid_per_member"),
                 ratio("total_billed", "claim_count").alias("avg_billed_per_claim"),
                 discount_rate("total_billed", "total_paid").alias("discount_rate"))
    if providers is not None:
        p = providers.select("provider_id", F.col("specialty").alias("provider_specialty"))
        g = g.join(p, "provider_id", "left")
    return g


def member_360(claims: DataFrame, members: DataFrame, providers: DataFrame | None,
               as_of, risk_cuts=DEFAULT_RISK_CUTS, chronic_min_claims: int = 2) -> DataFrame:
    """GLD-5/6/7: one row per member, claim-less members kept.

    The per-member lists (chronic conditions, primary care provider) are built
    from pre-aggregated (member, code) and (member, provider) counts, so a
    member with very many claims never materialises them in one group.
    """
    d = as_date(as_of)
    ytd = F.year("service_date") == F.year(d)
    ct = F.col("claim_type")
    # One pre-aggregation per (member, provider, diagnosis) feeds all three
    # roll-ups; the three branches share its exchange, so the claims are read
    # and shuffled once.
    pre = claims.groupBy("member_id", "provider_id", "diagnosis_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("paid_amount").alias("paid"), F.sum("billed_amount").alias("billed"),
        F.count_if(ct == "MEDICAL").alias("med"), F.count_if(ct == "DENTAL").alias("den"),
        F.count_if(ct == "PHARMACY").alias("pha"), F.count_if(ytd).alias("ytd_n"),
        F.sum(F.when(ytd, F.col("paid_amount"))).alias("ytd_paid"),
        F.max("service_date").alias("last_visit"))
    base = pre.groupBy("member_id").agg(
        F.sum("n").alias("total_claims"),
        F.sum("paid").cast(MONEY).alias("total_paid"),
        F.sum("billed").cast(MONEY).alias("total_billed"),
        F.sum("med").alias("medical_claims"),
        F.sum("den").alias("dental_claims"),
        F.sum("pha").alias("pharmacy_claims"),
        F.sum("ytd_n").alias("total_claims_ytd"),
        F.coalesce(F.sum("ytd_paid"), F.lit(0)).cast(MONEY).alias("total_paid_ytd"),
        F.max("last_visit").alias("last_visit_date"))
    # Primary care provider: most claims, ties to the lowest provider id.
    pcp = (pre.groupBy("member_id", "provider_id").agg(F.sum("n").alias("n"))
              .groupBy("member_id")
              .agg(F.max_by("provider_id", F.struct(F.col("n"), -F.col("provider_id"))).alias("pcp_id")))
    chronic = (pre.groupBy("member_id", "diagnosis_code").agg(F.sum("n").alias("n"))
                  .filter(F.col("n") >= chronic_min_claims)
                  .groupBy("member_id")
                  .agg(F.array_sort(F.collect_list("diagnosis_code")).alias("chronic_conditions")))
    m = (members.join(base, "member_id", "left").join(pcp, "member_id", "left")
                .join(chronic, "member_id", "left"))
    if providers is not None:
        m = m.join(providers.select(F.col("provider_id").alias("pcp_id"),
                                    F.col("provider_name").alias("primary_care_provider")), "pcp_id", "left")
    zero = F.lit(0)
    return m.select(
        "member_id", "tpa", "member_name", "date_of_birth", age_years("date_of_birth", d).alias("age"),
        "gender", "enrollment_date", "is_active",
        F.coalesce("total_claims", zero).alias("total_claims"),
        F.coalesce("total_paid", zero.cast(MONEY)).alias("total_paid"),
        F.coalesce("medical_claims", zero).alias("medical_claims"),
        F.coalesce("dental_claims", zero).alias("dental_claims"),
        F.coalesce("pharmacy_claims", zero).alias("pharmacy_claims"),
        F.coalesce("total_claims_ytd", zero).alias("total_claims_ytd"),
        F.coalesce("total_paid_ytd", zero.cast(MONEY)).alias("total_paid_ytd"),
        ratio("total_billed", "total_claims").alias("avg_billed_per_claim"),
        "last_visit_date",
        F.coalesce("chronic_conditions", F.array().cast("array<string>")).alias("chronic_conditions"),
        F.col("pcp_id").alias("primary_care_provider_id"),
        *(["primary_care_provider"] if providers is not None else []),
        risk_score(F.coalesce("total_paid", zero), risk_cuts).alias("risk_score"))


def readmissions(claims: DataFrame, days: int = 30) -> DataFrame:
    """GLD-9: per (tenant, provider, service date) the count of readmissions.

    A readmission is a visit of the same member at the same provider 1..days
    days after the member's previous visit there.  Claims are first reduced
    to distinct (member, provider, date) rows, so the window sees at most one
    row per calendar day per pair -- a hot member cannot blow up one task.
    A member's visits under another tenant are not visits of this one.
    """
    visits = claims.select("tpa", "member_id", "provider_id", "service_date").distinct()
    w = Window.partitionBy("tpa", "member_id", "provider_id").orderBy("service_date")
    gap = F.datediff(F.col("service_date"), F.lag("service_date").over(w))
    return (visits.withColumn("is_readmit", (gap >= 1) & (gap <= days))
                  .filter("is_readmit")
                  .groupBy("tpa", "provider_id", "service_date").agg(F.count(F.lit(1)).alias("readmits")))


def readmission_rates(claims: DataFrame, days: int = 30) -> DataFrame:
    """GLD-9: per tenant, provider and quarter: claims, readmissions and their ratio."""
    period = measurement_period().alias("measurement_period")
    total = claims.groupBy("tpa", "provider_id", period).agg(F.count(F.lit(1)).alias("total_claims"))
    again = (readmissions(claims, days).groupBy("tpa", "provider_id", period)
             .agg(F.sum("readmits").cast("bigint").alias("readmissions")))
    out = total.join(again, ["tpa", "provider_id", "measurement_period"], "left")
    n = F.coalesce("readmissions", F.lit(0).cast("bigint"))
    return out.select("tpa", "provider_id", "measurement_period", "total_claims", n.alias("readmissions"),
                      ratio(n, F.col("total_claims")).alias("readmission_rate"))


def measurement_period(date_col: str = "service_date") -> Column:
    return F.concat(F.year(date_col).cast("string"), F.lit("-Q"), F.quarter(date_col).cast("string"))


def provider_performance(claims: DataFrame, providers: DataFrame | None = None,
                         readmit_days: int | None = 30) -> DataFrame:
    """GLD-8/9: per provider and quarter."""
    g = (claims.groupBy("tpa", "provider_id", measurement_period().alias("measurement_period"))
               .agg(F.countDistinct("member_id").alias("unique_members"),
                    F.count(F.lit(1)).alias("total_claims"),
                    money_sum("paid_amount").alias("total_paid"),
                    money_sum("billed_amount").alias("total_billed")))
    g = g.select("*", ratio("total_paid", "unique_members").alias("avg_cost_per_member"),
                 ratio("total_paid", "total_claims").alias("avg_cost_per_claim"),
                 discount_rate("total_billed", "total_paid").alias("discount_rate"))
    if readmit_days is not None:
        r = (readmissions(claims, readmit_days)
             .groupBy("tpa", "provider_id", measurement_period().alias("measurement_period"))
             .agg(F.sum("readmits").alias("readmits")))
        g = (g.join(r, ["tpa", "provider_id", "measurement_period"], "left")
              .withColumn("readmission_rate", ratio(F.coalesce("readmits", F.lit(0)), F.col("total_claims")))
              .drop("readmits"))
    # No formula is given for the composite quality score: it stays NULL.
    g = g.withColumn("quality_score", F.lit(None).cast("double"))
    if providers is not None:
        g = g.join(providers.select("provider_id", "provider_name",
                                    F.col("specialty").alias("provider_specialty"), "provider_type"),
                   "provider_id", "left")
    return g


def financial_summary(claims: DataFrame) -> DataFrame:
    """GLD-10/11/12: per tpa, fiscal year/month/quarter and claim type, plus an
    'ALL' claim-type row per period.

    Sums and distinct members are taken apart: the sums shrink to one row per
    period and type before anything moves, only (period, type, member) keys are
    shuffled for the members; the 'ALL' rows are rolled up from both.
    """
    c = claims.select("tpa", F.year("service_date").alias("fiscal_year"),
                      F.month("service_date").alias("fiscal_month"),
                      F.quarter("service_date").alias("fiscal_quarter"),
                      "claim_type", "member_id", "billed_amount", "allowed_amount", "paid_amount",
                      (F.col("allowed_amount") - F.col("paid_amount")).alias("member_resp"))
    keys = ["tpa", "fiscal_year", "fiscal_month", "fiscal_quarter"]
    total = [*keys, F.lit(None).cast(c.schema["claim_type"].dataType).alias("claim_type"), F.lit(1).alias("_all")]
    money = ["total_billed", "total_allowed", "total_paid", "total_member_responsibility"]
    sums = c.groupBy(*keys, "claim_type", F.lit(0).alias("_all")).agg(
        money_sum("billed_amount").alias("total_billed"),
        money_sum("allowed_amount").alias("total_allowed"),
        money_sum("paid_amount").alias("total_paid"),
        money_sum("member_resp").alias("total_member_responsibility"),
        F.count(F.lit(1)).alias("claim_count"))
    seen = c.select(*keys, "claim_type", "member_id").distinct()
    n = F.count("member_id").alias("member_count")
    members = seen.groupBy(*keys, "claim_type", F.lit(0).alias("_all")).agg(n).unionByName(
        seen.select(*keys, "member_id").distinct().groupBy(*total).agg(n))
    none = [F.lit(None).cast(MONEY).alias(m) for m in money] + [F.lit(0).cast("bigint").alias("claim_count")]
    parts = (sums.select("*", F.lit(0).cast("bigint").alias("member_count"))
             .unionByName(sums.select(*total, *money, "claim_count", F.lit(0).cast("bigint").alias("member_count")))
             .unionByName(members.select(*keys, "claim_type", "_all", *none, "member_count")))
    g = parts.groupBy(*keys, "claim_type", "_all").agg(
        *[money_sum(m).alias(m) for m in money], F.sum("claim_count").alias("claim_count"), F.sum("member_count").alias("member_count"))
    return g.select(*keys,
                    F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col("claim_type")).alias("claim_type"),
                    "total_billed", "total_allowed", "total_paid", "total_member_responsibility",
                    "claim_count", "member_count",
                    ratio("total_paid", "member_count").alias("pmpm"),
                    ratio("total_paid", "total_billed").alias("medical_loss_ratio"))
