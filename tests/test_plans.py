"""Plan-shape checks for the scale properties the operators promise."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from claimlake.operators.joins import broadcast_if_small


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_scan_claims_at_most_twice(spark, sf_dir):
    plan = _plan(E.queries()["dq_rule_failures"](spark, sf_dir))
    # one pass for the row predicates, one grouped pass for all aggregate predicates
    assert plan.count("lineitem.parquet") <= 2


def test_auto_map_has_no_all_pairs_join(spark, sf_dir):
    plan = _plan(E.queries()["auto_map_scores"](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_gold_aggregates_push_and_prune(spark, sf_dir):
    plan = _plan(E.queries()["claims_analytics"](spark, sf_dir))
    scan = [l for l in plan.split("\n") if "lineitem.parquet" in l][0]
    assert "l_comment" not in scan and "l_returnflag" not in scan  # pruned read schema
    assert "CartesianProduct" not in plan


def test_checked_broadcast_respects_bound(spark, sf_dir):
    df = spark.range(10)
    big = broadcast_if_small(df, [f"{sf_dir}/orders.parquet"], max_bytes=0)
    small = broadcast_if_small(df, [f"{sf_dir}/orders.parquet"], max_bytes=1 << 40)
    j1 = spark.range(100).join(big, "id")
    j2 = spark.range(100).join(small, "id")
    assert "broadcast" not in j1._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in j2._jdf.queryExecution().analyzed().toString().lower()


def test_registered_plans_have_oracles_with_same_columns(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 120
    assert all(" limit " not in sql.lower() or any(k in n for k in ("next_batch", "recent", "top", "page", "browse",
                                                                  "list", "latest", "failures", "results",
                                                                  "disposition", "slow", "errors", "application",
                                                                  "file_processing_log"))
               for n, sql in o.items())


def test_metric_catalog_totals_the_values_of_every_metric(spark, sf_dir):
    """the category totals are sums of the metric values, in the plan and in its SQL."""
    want = {}
    for r in E.queries()["business_metrics"](spark, sf_dir).collect():
        want.setdefault(r.metric_category, []).append(r.metric_value)
    got = {r.metric_category: r.category_value_total for r in E.queries()["metric_catalog"](spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[c] - sum(v)) <= 1e-9 * abs(sum(v)) for c, v in want.items())
    assert "sum(metric_value) as category_value_total" in E.oracle_sql()["metric_catalog"]


def test_raw_rows_are_numbered_by_one_shuffle(spark, sf_dir):
    """record id and row number in the file come from one exchange and one sort."""
    from claimlake.plans import bindings as b
    plan = _plan(b.raw_rows(spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window [") == 2 and plan.count("- Sort [") == 1


def test_metric_views_share_one_join_of_the_claims(spark, sf_dir):
    """the views read claims that were joined and written once."""
    assert "lineitem.parquet" not in _plan(E.queries()["business_metrics"](spark, sf_dir))


def test_silver_merge_numbers_the_raw_rows_once(spark, sf_dir):
    """both batches read raw rows that were written once."""
    assert "lineitem.parquet" not in _plan(E.queries()["silver_merge"](spark, sf_dir))


def test_financial_summary_with_nulls_and_without_expand(spark):
    """F16: sums and members apart; null types are a type of their own, null members are not counted."""
    from claimlake.operators import gold
    rows = [("t", "2001-01-05", "A", 1, 10), ("t", "2001-01-06", "A", 1, 20), ("t", "2001-01-07", "B", 1, 5), ("t", "2001-01-07", None, 2, 1),
            ("t", "2001-01-08", "A", None, 2), ("t", None, "A", 3, 4)]
    df = spark.createDataFrame(rows, "tpa string, service_date string, claim_type string, member_id long, paid_amount int").selectExpr(
        "tpa", "cast(service_date as date) service_date", "claim_type", "member_id", *[f"cast(paid_amount as decimal(18,2)) {c}" for c in
                                                                                   ("billed_amount", "allowed_amount", "paid_amount")])
    out = gold.financial_summary(df)
    got = sorted(((r.fiscal_month or 0, r.claim_type or "", r.claim_count, int(r.total_paid), r.member_count) for r in out.collect()))
    assert got == [(0, "A", 1, 4, 1), (0, "ALL", 1, 4, 1), (1, "", 1, 1, 1), (1, "A", 3, 32, 1), (1, "ALL", 5, 38, 2), (1, "B", 1, 5, 1)]
    assert "Expand" not in _plan(out)


def test_rules_and_mappings_read_no_claims_again(spark, sf_dir):
    """Metadata taken from the claims is read from its own small table, however often a plan uses it."""
    from claimlake.plans import bindings as b
    assert "lineitem.parquet" not in _plan(b.silver_rules(spark, sf_dir)) + _plan(b.field_mappings(spark, sf_dir))


@pytest.mark.parametrize("name", ["tfidf_pairs", "append_mappings", "mapping_prompts", "validate_mappings", "auto_map_scores", "silver_stats"])
def test_plans_join_the_claims_once(spark, sf_dir, monkeypatch, name):
    """what several parts of a plan take from the claims comes from one pass."""
    from claimlake.plans import bindings as b
    joins, real = [], b._claims
    monkeypatch.setattr(b, "_claims", lambda *a: joins.append(a) or real(*a))
    E.queries()[name](spark, sf_dir)
    assert len(joins) == 1


def test_conformed_claims_are_joined_once(spark, sf_dir):
    """one pass for all tables of one structure, not one per table."""
    assert _plan(E.queries()["conform_claims"](spark, sf_dir)).count("lineitem.parquet") <= 1


def test_number_marks_are_the_casts(spark):
    """the form that is tested before a cast rules out nothing that the cast accepts."""
    from claimlake.plans import bindings as b
    values = ["1", " 1 ", "\t2\n", "+.5", "-1.", ".", "", "1e3", "1E-2", "1e", "1e400", "1e16", "\u0663", "1 2", "abc", "1d", "NaN", "1996-03-13", "12345678901234567.1", "x" * 51, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", b._marks(F.col("v")).alias("m"), (F.col("v").isNotNull() & F.col("v").try_cast("decimal(18,2)").isNull()).alias("text"),
                    (F.col("v").isNotNull() & F.col("v").try_cast("date").isNull()).alias("undated")).collect()
    for r in got:
        assert r.m == r.text + 2 * r.undated + 4 * (r.v is not None and len(r.v) > 50) + 16 * (r.v is None), r


@pytest.mark.parametrize("name", ["corrected_rows", "correction_audit", "dq_rule_failures", "business_logic_cols", "rule_routing_counts", "quarantine_rows"])
def test_claims_are_joined_once_for_rules_and_rows(spark, sf_dir, name, monkeypatch):
    from claimlake.plans import bindings as b
    calls, claims = [], b.claims
    monkeypatch.setattr(b, "claims", lambda *a, **k: calls.append(a) or claims(*a, **k))
    assert "lineitem.parquet" not in _plan(E.queries()[name](spark, sf_dir)) and len(calls) == 1
