import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimlake.functions.dates import boundary_diff
from claimlake.functions.dialect import split_alias, to_spark_sql
from claimlake.operators import bronze as br
from claimlake.operators import journeys as jr
from claimlake.operators import merge as mg
from claimlake.operators import quality as q
from claimlake.operators import rules as ru
from claimlake.operators import transform as tr
from claimlake.operators.sequence import with_sequence_id


def test_boundary_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1),
                                 dt.date(2000, 12, 31), dt.date(2024, 1, 1))], "a timestamp_ntz, b timestamp_ntz, "
                                                                                 "d1 date, d2 date")
    r = df.select(boundary_diff("hour", "a", "b").alias("h"), boundary_diff("year", "d1", "d2").alias("y"),
                  boundary_diff("day", "d1", "d2").alias("d"), boundary_diff("second", "a", "b").alias("s")).first()
    assert (r.h, r.y, r.s) == (1, 24, 120)
    assert r.d == (dt.date(2024, 1, 1) - dt.date(2000, 12, 31)).days


def test_dialect_shim():
    assert to_spark_sql("TO_NUMBER(X)") == "try_cast(X AS DECIMAL(18,2))"
    assert to_spark_sql("SERVICE_DATE <= CURRENT_DATE()", "2001-12-31") == "SERVICE_DATE <= DATE'2001-12-31'"
    assert "try_divide(PAID, BILLED)" in to_spark_sql("PAID / BILLED")
    assert split_alias("A / B AS RATE") == ("A / B", "RATE")
    assert "'MM/dd/yyyy'" in to_spark_sql("TO_DATE(x, 'MM/dd/yyyy')")


def test_sequence_ids_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("v"))
    out = with_sequence_id(df.repartition(7), ["k"], "rid", num_partitions=5)
    rows = sorted((r.k, r.rid) for r in out.collect())
    assert [r[1] for r in rows] == list(range(1, 1001))


def test_merge_upsert_idempotent_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a", 10), (None, "n", 1), (2, "b", 20)], "k int, v string, x int")
    s = spark.createDataFrame([(1, "A", 11), (3, "c", 30), (None, "N", 2), (1, "A2", 12)], "k int, v string, x int")
    once = mg.merge_upsert(t, s, ["k"], order_by=["x"])
    twice = mg.merge_upsert(once, s, ["k"], order_by=["x"])
    a = sorted(map(tuple, once.collect()), key=str)
    assert a == sorted(map(tuple, twice.collect()), key=str)
    assert sorted(a, key=str) == sorted([(1, "A2", 12), (None, "N", 2), (2, "b", 20), (3, "c", 30)], key=str)
    ins = mg.insert_only(t, s, ["k"]).collect()
    assert len(ins) == 4


def test_queue_state_machine(spark):
    q0 = spark.createDataFrame([(1, "PROCESSING", 0), (2, "PROCESSING", 2), (3, "PROCESSING", 0), (4, "PENDING", 0)],
                               "queue_id long, status string, retry_count int").withColumn(
        "processed_timestamp", F.lit(None).cast("timestamp_ntz"))
    res = spark.createDataFrame([(1, "SUCCESS: 5 rows"), (2, "ERROR: " + "x" * 6000), (3, "SKIPPED: loaded")],
                                "queue_id long, result string")
    out = {r.queue_id: r for r in br.apply_results(q0, res, "2024-01-01 00:00:00").collect()}
    assert out[1].status == "SUCCESS" and out[2].status == "FAILED" and out[2].retry_count == 3
    assert len(out[2].error_message) == 5000 and out[3].status == "SKIPPED" and out[4].status == "PENDING"
    strict = {r.queue_id: r.status for r in br.apply_results(q0, res, "2024-01-01", True).collect()}
    assert strict[3] == "FAILED"


def test_discover_files_ignores_null_names(spark):
    listing = spark.createDataFrame([("a/x.csv", 1), ("b/y.XLSX", 2), ("z.txt", 3)], "file_name string, size long")
    queue = spark.createDataFrame([("a/x.csv",), (None,)], "file_name string")
    rows = {r.file_name: r for r in br.discover_files(listing, queue).collect()}
    assert set(rows) == {"b/y.XLSX", "z.txt"} and rows["b/y.XLSX"].file_type == "EXCEL"


def test_landing_kpis_case_insensitive_and_drops_rootless(spark):
    l = spark.createDataFrame([("SRC", "Prov_A/x.csv", 5), ("SRC", "prov_a/y.csv", 7), ("SRC", "loose.csv", 1)],
                              "stage string, file_name string, size long")
    rows = br.landing_kpis(l, ["PROV_A"]).collect()
    assert sorted((r.tpa, r.file_count) for r in rows) == [("Prov_A", 1), ("prov_a", 1)]


def test_rules_route_every_row_once(spark):
    df = spark.createDataFrame([("t", "C1", 10.0, dt.date(2020, 1, 1)), ("t", None, 5.0, dt.date(2020, 1, 1)),
                                ("t", "C3", -1.0, dt.date(2030, 1, 1)), ("u", "C4", None, dt.date(2020, 1, 1))],
                               "tpa string, claim_id string, billed double, service_date date")
    rules = spark.createDataFrame([
        ("R1", "t", "DATA_QUALITY", "claim_id IS NOT NULL", "REJECT", 1, True),
        ("R2", "t", "DATA_QUALITY", "billed >= 0", "QUARANTINE", 2, True),
        ("R3", "t", "DATA_QUALITY", "service_date <= CURRENT_DATE()", "FLAG", 3, True),
        ("R4", "u", "DATA_QUALITY", "billed >= 0", "QUARANTINE", 1, True),
        ("R5", "t", "DATA_QUALITY", "billed > 1000", "REJECT", 1, False),
        ("R6", "t", "DATA_QUALITY", "missing_col > 0", "REJECT", 1, True),
        ("R7", "t", "DATA_QUALITY", "SUM(billed) > 0", "FLAG", 1, True),
        ("B1", "t", "BUSINESS_LOGIC", "billed / 0 AS ratio", "FLAG", 1, True),
    ], "rule_id string, tpa string, rule_type string, rule_logic string, error_action string, priority int, "
       "active boolean").withColumn("target_table", F.lit("T")).withColumn("target_column", F.lit(None).cast("string"))
    out, errors = ru.apply_rules(df, rules, "2024-01-01")
    assert [e["rule_id"] for e in errors] == ["R6"]
    fails = {r.claim_id: sorted(r._failed_rules) for r in out.collect()}
    assert fails["C1"] == [] and fails[None] == ["R1"] and fails["C3"] == ["R2", "R3"] and fails["C4"] == ["R4"]
    clean, quar, rej = ru.route(out)
    assert clean.count() + quar.count() + rej.count() == df.count()
    assert [r.claim_id for r in rej.collect()] == [None]
    assert out.filter("ratio is not null").count() == 0  # division by zero -> NULL, not an error
    qrows = ru.to_quarantine(quar, rules, "B1", "2024-01-01", "RAW", "T", id_col="claim_id").collect()
    assert sorted((r.claim_id, r.rule_id) for r in qrows) == [("C3", "R2"), ("C3", "R3"), ("C4", "R4")]


def test_dedupe_exact_hot_key(spark):
    rows = [(i, "same") for i in range(50)] + [(100, "other")]
    df = spark.createDataFrame(rows, "id int, text string")
    out = {r.id: r.duplicate_of for r in ru.dedupe_exact(df, ["text"]).collect()}
    assert out[0] is None and out[100] is None and all(out[i] == 0 for i in range(1, 50))


def test_timeline_ties_and_journeys_without_events(spark):
    j = spark.createDataFrame([("J1", 1, "t", "x", dt.date(2024, 1, 1)), ("J2", 2, "t", "x", dt.date(2024, 1, 1))],
                              "journey_id string, member_id long, tpa string, journey_type string, start_date date")
    e = spark.createDataFrame([("E2", "J1", 1, "a", dt.date(2024, 1, 2), 1.0, 1, 2),
                               ("E1", "J1", 1, "a", dt.date(2024, 1, 2), 1.0, 1, 1),
                               ("E3", "J1", 1, "a", dt.date(2024, 1, 1), 1.0, 2, 3)],
                              "event_id string, journey_id string, member_id long, event_type string, event_date date, "
                              "cost double, provider_id int, event_seq long")
    rows = sorted((r.event_id, r.event_sequence) for r in jr.timeline(j, e).collect())
    assert rows == [("E1", 2), ("E2", 3), ("E3", 1)]
    jm = j.withColumns({"num_visits": F.lit(9), "total_cost": F.lit(5).cast("decimal(18,2)"),
                        "num_providers": F.lit(1)})
    upd = {r.journey_id: r.num_visits for r in jr.update_journey_metrics(jm, e).collect()}
    assert upd == {"J1": 3, "J2": 9}


def test_dq_metrics_null_passed_counts_as_failed(spark):
    df = spark.createDataFrame([("t", "T", None)], "tpa string, target_table string, _load_timestamp timestamp_ntz")
    rows = {r.metric_name: r for r in q.dq_metrics(df, ["tpa", "target_table"], "_load_timestamp",
                                                  "2024-01-01 00:00:00", "B1").collect()}
    assert rows["ROW_COUNT"].passed is True and rows["DATA_FRESHNESS_HOURS"].passed is None
    assert rows["OVERALL_QUALITY_SCORE"].metric_value == 50.0


def test_project_mapped_two_sources_one_target_and_blank_keys(spark):
    raw = spark.createDataFrame([(1, "f", 1, "a", '{"First Name":"Ann","X":"1","Y":"2"}'),
                                 (2, "f", 2, "b", '{"X":"3"}')],
                                "record_id long, file_name string, file_row_number long, tpa string, raw_data string")
    m = spark.createDataFrame([(1, "a", "First Name", "T", "NAME", "MANUAL", True, True, None),
                               (2, "a", "Y", "T", "V", "MANUAL", True, True, "TO_NUMBER(Y)"),
                               (3, "a", "X", "T", "V", "MANUAL", True, True, None),
                               (4, "b", "X", "T", "V", "ML_AUTO", True, True, "Scores: ...")],
                              "mapping_id long, tpa string, source_field string, target_table string, "
                              "target_column string, mapping_method string, approved boolean, active boolean, "
                              "transformation_logic string")
    out = {r.record_id: r for r in tr.project_mapped(raw, m, "T").collect()}
    assert out[1].NAME == "Ann" and out[1].V == "2" and out[2].V == "3"
    typed = {r.record_id: r for r in tr.project_mapped(raw, m, "T", apply_logic=True).collect()}
    assert str(typed[1].V) == "2.00" and str(typed[2].V) == "3.00"


def test_project_mapped_is_the_same_for_few_and_many_mappings(spark):
    schema = ("mapping_id long, tpa string, source_field string, target_table string, target_column string, "
              "mapping_method string, approved boolean, active boolean, transformation_logic string")
    few = [(i, "a", f"K{i}", "T", f"C{i}", "MANUAL", True, True, "TO_NUMBER(K%d)" % i if i % 2 else None) for i in range(10)]
    many = few + [(100 + 10 * k + i, f"t{k}", f"F{i}", "T", f"C{i}", "MANUAL", True, True, "TO_NUMBER(F%d)" % i if i % 2 else None)
                  for k in range(1000) for i in range(10)]
    raw = spark.createDataFrame([(1, "f", 1, "a", '{"K0":"x","K1":"2.5","K3":"bad"}'), (2, "f", 2, "a", '{"other":"1"}'),
                                 (3, "f", 3, "t7", '{"F1":"4","F2":null}'), (4, "f", 4, "nobody", '{"F1":"4"}')],
                                "record_id long, file_name string, file_row_number long, tpa string, raw_data string")
    a = tr.project_mapped(raw, spark.createDataFrame(few, schema), "T", apply_logic=True)
    b = tr.project_mapped(raw, spark.createDataFrame(many, schema), "T", apply_logic=True)
    assert a.schema == b.schema and dict(a.dtypes)["C1"].startswith("decimal") and dict(a.dtypes)["C0"] == "string"
    rows_a, rows_b = ({r.record_id: r for r in x.collect()} for x in (a, b))
    assert set(rows_a) == {1, 2} and set(rows_b) == {1, 2, 3} and all(rows_a[k] == rows_b[k] for k in rows_a)
    assert rows_a[2].C0 is None and rows_a[1].C0 == "x" and str(rows_a[1].C1) == "2.50" and rows_a[1].C3 is None and str(rows_b[3].C1) == "4.00"


def test_readmissions_stay_within_a_tenant(spark):
    from claimlake.operators import gold
    rows = [("a", "m", "p", "2024-01-01"), ("b", "m", "p", "2024-01-10"), ("a", "m", "p", "2024-01-20"), ("a", "n", "p", "2024-01-05")]
    c = spark.createDataFrame(rows, "tpa string, member_id string, provider_id string, d string").select("*", F.to_date("d").alias("service_date"))
    got = {r.tpa: (r.total_claims, r.readmissions) for r in gold.readmission_rates(c).collect()}
    assert got == {"a": (3, 1), "b": (1, 0)}


def test_fuzzy_words_of_any_script(spark):
    from claimlake.operators import rules
    df = spark.createDataFrame([(1, "данные клиента номер один"), (2, "совсем другой текст здесь"), (3, "данные клиента номер один")], "id long, t string")
    got = {r.id: r.duplicate_of for r in rules.fuzzy_dedupe(df, "id", "t").collect()}
    assert got == {1: None, 2: None, 3: 1}


def test_suggestions_with_quoted_confidence(spark):
    from claimlake.operators import mapping as mp
    df = spark.createDataFrame([('[{"source_field":"a","target_field":"b","confidence":"0.9","reasoning":"r"}]',)], "response string")
    assert [r.confidence for r in mp.parse_responses(df).collect()] == [0.9]


def test_quality_rules_order_and_batch_cap(spark):
    from claimlake.operators import gold_rules as gr
    rules = gr.catalog_df(spark, "quality")
    names = [r.rule_name for r in gr.quality_rules_for(rules, "asia").collect()]
    assert names == ["CHECK_DATA_FRESHNESS", "CHECK_DISCOUNT_RATE", "CHECK_MEMBER_COUNT", "CHECK_NEGATIVE_AMOUNTS",
                     "CHECK_REQUIRED_FIELDS"]  # severity text desc, then name
    df = spark.range(10).select(F.col("id").alias("record_id"))
    assert [r.record_id for r in tr.batch_cap(df, 3).collect()] == [0, 1, 2]
    assert tr.batch_cap(df, None).count() == 10


def test_sequence_ids_text_key_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    rows = sorted((r.rid, r.k) for r in with_sequence_id(df, ["k"], "rid", num_partitions=3).collect())
    assert rows == [(1, None), (2, "a"), (3, "b"), (4, "c")]
    df2 = spark.createDataFrame([(3,), (None,), (1,), (2,), (2,)], "k int")
    rows2 = sorted((r.rid, r.k) for r in with_sequence_id(df2, ["k"], "rid", num_partitions=4).collect())
    assert [r[0] for r in rows2] == [1, 2, 3, 4, 5] and [r[1] for r in rows2] == [None, 1, 2, 2, 3]


def test_resolve_keys_case_insensitive(spark):
    m = spark.createDataFrame([("t", "first name"), ("t", "DOB"), ("t", "X")], "tpa string, source_field string")
    sf = spark.createDataFrame([("t", "First Name"), ("t", "DOB"), ("t", "dob"), ("t", "x"), ("t", "X ")],
                               "tpa string, source_field string")
    got = {r.source_field: (r.raw_key, r.ambiguous) for r in tr.resolve_keys(m, sf).collect()}
    assert got["first name"] == ("First Name", False)
    assert got["DOB"] == ("DOB", True)  # exact spelling wins, ambiguity reported
    assert got["X"][1] is True


def test_metrics_per_tenant_and_bad_texts(spark):
    from claimlake.operators import gold_rules as gr
    t = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "y"), ("b", 10.0, "x")], "tpa string, v double, k string")
    ms = spark.createDataFrame([("all", "c", "ALL", "SUM(v) FROM T", True), ("of_b", "c", "b", "SUM(v) FROM T", True), ("cond", "c", "a", "AVG(v) FROM T WHERE k = 'y'", True),
                                ("bad", "c", "ALL", "SUM(nope) FROM T", True), ("other", "c", "ALL", "SUM(v) FROM U", True), ("med", "c", "a", "MEDIAN(v) FROM T WHERE k = 'x'", True)],
                               "metric_name string, metric_category string, tpa string, calculation_logic string, is_active boolean")
    got = {r.metric_name: r.metric_value for r in gr.evaluate_metrics(spark, ms, {"T": t}).collect()}
    assert got == {"all": 14.0, "of_b": 10.0, "cond": 3.0, "bad": None, "other": None, "med": 1.0}


def test_gold_mappings_with_two_group_lists_are_refused(spark):
    from claimlake.operators import gold_rules as gr
    src = spark.createDataFrame([("a", 1)], "k string, v int")
    m = spark.createDataFrame([("T", "x", "v", None, "SUM", "k", None, True, 1), ("T", "y", "v", None, "SUM", "k, v", None, True, 2)],
                              "target_table string, target_field string, source_field string, transformation_logic string, aggregation_function string, "
                              "group_by_fields string, filter_condition string, is_active boolean, priority int")
    with pytest.raises(ValueError):
        gr.run_gold_mappings(src, m, "T")


def test_quality_rule_of_a_tenant_sees_its_rows(spark):
    from claimlake.operators import gold_rules as gr
    t = spark.createDataFrame([("a", -1.0), ("b", 2.0)], "tpa string, total_paid double")
    rules = spark.createDataFrame([("R", "T", "b", "total_paid >= 0", 1.0, ">=", "ERROR", True), ("S", "T", "ALL", "total_paid >= 0", 1.0, ">=", "ERROR", True)],
                                  "rule_name string, table_name string, tpa string, check_logic string, threshold_value double, threshold_operator string, severity string, is_active boolean")
    got = {r.rule_name: (r.records_checked, r.status) for r in gr.run_quality_rules({"T": t}, rules, "run", "2024-01-01 00:00:00").collect()}
    assert got == {"R": (1, "PASSED"), "S": (2, "FAILED")}


def test_reprocessed_records_come_back_once(spark):
    from claimlake.operators import rules
    q = spark.createDataFrame([("b1", "r1", 7, '{"_record_id":7,"tpa":"a","v":5}', False), ("b1", "r2", 7, '{"_record_id":7,"tpa":"a","v":5}', False)],
                              "batch_id string, rule_id string, _record_id long, record_data string, reprocessed boolean")
    rl = spark.createDataFrame([], "rule_id string, rule_name string, rule_type string, tpa string, target_table string, rule_logic string, "
                                   "error_action string, priority int, active boolean")
    out, marked = rules.reprocess_quarantine(q, "_record_id long, tpa string, v int", rl, "2024-01-01 00:00:00")
    assert out.count() == 1 and marked.filter("reprocessed").count() == 2


def test_rules_and_conforming_cover_every_claim_table(spark, sf_dir):
    import datetime as dt
    from collections import Counter, defaultdict

    import __spark_entry__ as E
    from claimlake.plans import bindings as b
    q = E.queries()
    claims = b.claims(spark, sf_dir).collect()
    groups = defaultdict(list)
    for c in claims:
        groups[c.tpa, c.claim_type + "_CLAIMS"].append(c)
    assert len({t for _, t in groups}) == 3
    want, rate = Counter(), Counter()
    for (tpa, table), rows in groups.items():
        bills = [c.billed_amount for c in rows if c.billed_amount is not None]
        dear = not bills or sum(bills) / len(bills) >= 38000
        for c in rows:
            ok = {"DQ001": c.claim_id is not None, "DQ002": c.service_date is not None and c.service_date <= dt.date(1998, 6, 30),
                  "DQ003": c.billed_amount is not None and c.billed_amount >= 0, "DQ004": c.paid_amount is not None and c.paid_amount <= 80000, "DQ006": not dear}
            want[c.claim_id, tpa, table, ",".join(k for k, v in ok.items() if not v)] += 1
            rate[c.claim_id, tpa, table, round(float(c.paid_amount) / float(c.billed_amount), 9) if c.billed_amount else None] += 1
    got = Counter(tuple(r) for r in q["dq_rule_failures"](spark, sf_dir).select("claim_id", "tpa", "table_name", "failed_rules").collect())
    assert got == want
    assert rate == Counter((r.claim_id, r.tpa, r.table_name, None if r.discount_rate is None else round(r.discount_rate, 9))
                           for r in q["business_logic_cols"](spark, sf_dir).collect())

    def route(f):
        return "REJECT" if "DQ001" in f else "QUARANTINE" if "DQ002" in f or "DQ003" in f else "FLAG" if f else None
    counts = {(r.tpa, r.table_name): r for r in q["rule_routing_counts"](spark, sf_dir).collect()}
    assert counts.keys() == groups.keys()
    for k, r in counts.items():
        n = Counter()
        for (_, tpa, table, f), m in want.items():
            if (tpa, table) == k:
                n[route(f)] += m
        assert (r.input_rows, r.clean_rows, r.flagged_rows, r.quarantined_rows, r.rejected_rows) == (len(groups[k]), n[None], n["FLAG"], n["QUARANTINE"], n["REJECT"])
    held = Counter((r.claim_id, r.tpa, r.target_table, r.rule_id) for r in q["quarantine_rows"](spark, sf_dir).collect())
    assert held == Counter((c, tpa, table, rule) for (c, tpa, table, f), m in want.items() if route(f) == "QUARANTINE" for rule in f.split(",") for _ in range(m))
    conformed = q["conform_claims"](spark, sf_dir)
    assert {(r.tpa, r.table_name): r["count"] for r in conformed.groupBy("tpa", "table_name").count().collect()} == {k: len(v) for k, v in groups.items()}
    defined = b.target_schemas(spark, sf_dir)
    assert {r.column_name for r in defined.collect()} <= set(conformed.columns)


RULE_SCHEMA = ("rule_id string, tpa string, target_table string, rule_type string, target_column string, rule_logic string, error_action string, priority int, "
               "active boolean, correction string, fallback_action string")


def test_corrections_until_rules_hold(spark):
    rules = spark.createDataFrame([
        ("A", "t", "T", "DATA_QUALITY", "a", "a <= b", "CORRECT", 1, True, "b", None),
        ("B", "t", "T", "DATA_QUALITY", "b", "b >= 0", "CORRECT", 2, True, "0", None),          # may break A, which is swept again
        ("C", "t", "T", "DATA_QUALITY", "c", "c <> 'x'", "CORRECT", 3, True, "concat(c, '')", "QUARANTINE"),  # mends nothing
        ("D", "t", "T", "DATA_QUALITY", "c", "length(c) < 5", "CORRECT", 4, True, None, "REJECT"),
        ("E", "t", "T", "DATA_QUALITY", "a", "a < 100", "CORRECT", 5, True, "nonsense(a)", None),  # reported; the rule falls to FLAG
        ("F", "t", "T", "DATA_QUALITY", "a", "DATEDIFF('fortnight', a, b) > 0", "REJECT", 6, True, None, None),  # reported, not raised
    ], RULE_SCHEMA)
    df = spark.createDataFrame([(1, "t", 5, 7, "ok"), (2, "t", 9, 7, "ok"), (3, "t", -1, -4, "ok"), (4, "t", None, 3, "x"), (5, "t", 1, 2, "longer"),
                                (6, "u", 9, 7, "x"), (7, None, 9, 7, "x"), (8, "t", 200, 300, None), (9, "t", -9, -4, "ok")], "id int, tpa string, a int, b int, c string")
    out, errors = ru.apply_rules(df, rules, "2024-01-01")
    assert sorted(e["rule_id"] for e in errors) == ["E", "F"]
    got = {r.id: r for r in out.withColumn("action", ru.strictest_action(out._failed_actions)).collect()}
    what = {i: ((r.a, r.b, r.c), [(c.rule_id, c.before, c.after) for c in r._corrections], sorted(r._failed_rules), r.action) for i, r in got.items()}
    assert what == {
        1: ((5, 7, "ok"), [], [], None),
        2: ((7, 7, "ok"), [("A", "9", "7")], [], None),
        3: ((-4, 0, "ok"), [("A", "-1", "-4"), ("B", "-4", "0")], [], None),
        4: ((3, 3, "x"), [("A", None, "3"), ("C", "x", "x")], ["C"], "QUARANTINE"),
        5: ((1, 2, "longer"), [], ["D"], "REJECT"),
        6: ((9, 7, "x"), [], [], None), 7: ((9, 7, "x"), [], [], None),
        8: ((200, 300, None), [("C", None, None)], ["C", "D", "E"], "REJECT"),
        9: ((-9, 0, "ok"), [("B", "-4", "0")], [], None)}
    audit = ru.correction_audit(out, "B1", "2024-01-01", id_col="id").collect()
    assert sorted((r.id, r.step, r.rule_id, r.mended) for r in audit) == [(2, 0, "A", True), (3, 0, "A", True), (3, 1, "B", True), (4, 0, "A", True), (4, 1, "C", False), (8, 0, "C", False), (9, 0, "B", True)]


def test_corrections_are_listed_in_one_step(spark):
    rules = spark.createDataFrame([("A", "t", "T", "DATA_QUALITY", "a", "a <= b", "CORRECT", 1, True, "b", None),
                                   ("B", "t", "T", "DATA_QUALITY", "b", "b >= c", "CORRECT", 2, True, "c", None),
                                   ("C", "t", "T", "DATA_QUALITY", "c", "c >= 0 and a < 9", "CORRECT", 3, True, "0", None)], RULE_SCHEMA)
    df = spark.createDataFrame([(1, "t", 5, 1, -3), (2, "t", 0, 1, 1), (3, "t", None, -2, -1), (4, "t", 9, 2, 3)], "id int, tpa string, a int, b int, c int")
    out, errors = ru.apply_rules(df, rules, "2024-01-01")
    assert not errors and out.columns == [*df.columns, "_corrections", "_failed_rules", "_failed_actions"]
    # the steps carry flags and values; the list of structs is not copied from step to step
    assert sum("_corrections" in x and "struct(rule_id" in x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n")) == 1
    got = {r.id: ((r.a, r.b, r.c), [tuple(c) for c in r._corrections], r._failed_rules) for r in out.collect()}
    assert got == {
        1: ((1, 1, 0), [("A", "a", "5", "1"), ("C", "c", "-3", "0")], []),
        2: ((0, 1, 1), [], []),
        3: ((-2, -1, 0), [("A", "a", None, "-2"), ("B", "b", "-2", "-1"), ("C", "c", "-1", "0")], ["B"]),
        4: ((2, 3, 3), [("A", "a", "9", "2"), ("B", "b", "2", "3")], [])}


def test_rule_plan_does_not_grow_with_tenants(spark):
    def plan(n):
        rows = [(f"R{i}", f"t{t}", "T", "DATA_QUALITY", "a", f"a > {i}", "FLAG", i, True, None, None) for t in range(n) for i in range(4)]
        df = spark.range(10).select(F.col("id").alias("a"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("tpa"))
        out, _ = ru.apply_rules(df, spark.createDataFrame(rows, RULE_SCHEMA), "2024-01-01")
        return out, out._jdf.queryExecution().analyzed().toString().count("CASE WHEN")
    (few, a), (many, b) = plan(3), plan(1000)
    assert a == b
    assert sorted((r.a, r._failed_rules) for r in few.collect()) == sorted((r.a, r._failed_rules) for r in many.collect())
