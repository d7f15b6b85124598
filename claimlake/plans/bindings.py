"""Claims entities derived from the driver's TPC-H-like tables.

Region plays the tenant (TPA), customer the member, supplier the provider,
lineitem the claim line, orders the claim header / landing file, events the
journey events and the log stream.  The same definitions exist as DuckDB SQL
in :mod:`claimlake.plans.oracle_views`; both must stay in step.

Joins to ``nation``/``region`` are broadcast: both are fixed-size reference
tables (25 and 5 rows at every scale factor).  Every other join is left to
AQE, which only turns a side into a broadcast after measuring it.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions.text import file_type
from claimlake.operators.joins import broadcast_if_small
from claimlake.operators.sequence import with_sequence_id
from claimlake.session import discard, written
from claimlake.sources.tables import table

# Fixed "now" values so that results repeat.
CLAIMS_AS_OF = _dt.date(2001, 12, 31)
EVENTS_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
JOURNEY_OPEN_FROM = _dt.date(2024, 1, 27)

CLAIM_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


def _geo(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return F.broadcast(
        n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
         .select("n_nationkey", F.lower(F.replace(F.col("r_name"), F.lit(" "), F.lit("_"))).alias("tpa")))


def tpa_master(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "region")
    return r.select(
        F.lower(F.replace(F.col("r_name"), F.lit(" "), F.lit("_"))).alias("tpa_code"),
        F.col("r_name").alias("tpa_name"),
        (F.col("r_regionkey") != 4).alias("active"),
        F.col("r_regionkey").alias("tpa_rank"))


def _claim_columns():
    """The claims from the rows of ``_joined``."""
    return [
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]).alias("claim_id"),
        F.col("tpa"), F.col("member_id"), F.col("l_suppkey").alias("provider_id"), F.col("claim_type"),
        F.col("l_shipdate").cast("date").alias("service_date"), F.col("received_date"), F.col("diagnosis_code"), F.col("claim_status"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("billed_amount"), F.col("allowed_amount"), F.col("paid_amount"),
        F.col("l_orderkey").alias("order_key"),
    ]


def members(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    g = _geo(spark, d)
    k = F.col("c_custkey")
    return (c.join(g, c.c_nationkey == g.n_nationkey)
             .select(k.alias("member_id"), "tpa", F.col("c_name").alias("member_name"),
                     F.date_add(F.lit(_dt.date(1930, 1, 1)), ((k * 37) % 25000).cast("int")).alias("date_of_birth"),
                     F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("O").alias("gender"),
                     F.date_add(F.lit(_dt.date(1994, 1, 1)), (k % 700).cast("int")).alias("enrollment_date"),
                     (k % 4 != 0).alias("is_active"),
                     F.col("c_acctbal").alias("account_balance")))


def providers(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    g = _geo(spark, d)
    nk = F.col("s_nationkey")
    return (s.join(g, s.s_nationkey == g.n_nationkey)
             .select(F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("provider_name"), "tpa",
                     F.when(nk % 4 == 0, "PRIMARY CARE").when(nk % 4 == 1, "CARDIOLOGY")
                      .when(nk % 4 == 2, "DENTISTRY").otherwise("PHARMACY").alias("specialty"),
                     F.when(F.col("s_suppkey") % 2 == 0, "Individual").otherwise("Facility").alias("provider_type")))


def claims(spark: SparkSession, d: str, with_record_id: bool = False) -> DataFrame:
    """One row per claim line, money as decimal(18,2)."""
    return _claims(spark, d, True).drop("file_row_number") if with_record_id else _claims(spark, d)


def stored_raw_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``raw_rows`` and the (tenant, claim type) pairs in them, both written.

    The claims are joined once and written; pairs, numbers and rows are made from there, and the shuffles of the join are gone by then.
    """
    joined = stored_claims(spark, d)
    pairs = written(joined.select("tpa", "claim_type").distinct(), "claims-profile")
    raw = written(raw_rows(spark, d, claim_rows=_numbered(joined, joined)), "raw-rows")
    discard(joined)
    return raw, pairs


def stored_claims(spark: SparkSession, d: str) -> DataFrame:
    """The joined rows from which ``as_claims`` makes the claims, written."""
    return written(_joined(spark, d), "claims-joined")


def as_claims(joined: DataFrame) -> DataFrame:
    return joined.select(*_claim_columns())


def _claims(spark: SparkSession, d: str, numbered: bool = False) -> DataFrame:
    """``numbered`` adds record_id (1.. over all lines) and file_row_number (1.. over the lines of an order)."""
    j = _joined(spark, d)
    return _numbered(j, table(spark, d, "lineitem")) if numbered else as_claims(j)


def _joined(spark: SparkSession, d: str) -> DataFrame:
    """Claim lines with what comes from their orders, members and parts: the columns that order the claims, and the claims' own."""
    l = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    p = table(spark, d, "part")
    m = members(spark, d).select("member_id", "tpa")
    billed = F.col("l_extendedprice").cast("decimal(18,2)")
    net = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    allowed = F.round(billed * net, 2).cast("decimal(18,2)")
    paid = F.round(billed * net * (F.lit(1) - F.col("l_tax").cast("decimal(4,2)")), 2).cast("decimal(18,2)")
    ptype = F.col("p_type")
    # Join order written out (no cost-based reordering): the tenant comes to
    # the orders first (orders-sized shuffle), so the claim lines are shuffled
    # twice (by order, by part) instead of three times.
    oh = (o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
           .join(m, o.o_custkey == m.member_id))
    # small inputs: broadcast the enriched orders (checked on the file sizes)
    oh = broadcast_if_small(oh, [os.path.join(d, f"{t}.parquet") for t in ("orders", "customer")])
    j = (l.join(oh, l.l_orderkey == oh.o_orderkey)
          .join(p.select("p_partkey", "p_type", "p_brand"), l.l_partkey == p.p_partkey))
    member = F.col("o_custkey").alias("member_id")
    claim_type = (F.when(ptype.isin("MEDIUM", "STANDARD"), "MEDICAL").when(ptype.isin("LARGE", "PROMO"), "DENTAL")
                   .otherwise("PHARMACY").alias("claim_type"))
    received, diagnosis = F.col("o_orderdate").cast("date").alias("received_date"), F.col("p_brand").alias("diagnosis_code")
    status = (F.when(F.col("o_orderstatus") == "F", "PAID").when(F.col("o_orderstatus") == "P", "DENIED")
               .otherwise("PENDING").alias("claim_status"))
    allowed, paid = allowed.alias("allowed_amount"), paid.alias("paid_amount")
    return j.select(*CLAIM_ORDER, "tpa", member, claim_type, received, diagnosis, status, allowed, paid)


def _numbered(joined: DataFrame, lead_from: DataFrame) -> DataFrame:
    # what follows from the order columns is derived after the numbering, so that it is not shuffled
    j = with_sequence_id(joined, CLAIM_ORDER, "record_id", lead_from=lead_from, position=("file_row_number", 1))
    return j.select(*_claim_columns(), "record_id", "file_row_number")


def queue(spark: SparkSession, d: str) -> DataFrame:
    """File processing queue: one landing file per order."""
    o = table(spark, d, "orders")
    m = members(spark, d).select("member_id", "tpa")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    suffix = (F.when(k % 4 == 0, ".csv").when(k % 4 == 1, ".CSV.gz").when(k % 4 == 2, ".xlsx").otherwise(".txt"))
    fname = F.concat(F.col("tpa"), F.lit("/order-"), k.cast("string"), suffix)
    return (o.join(m, o.o_custkey == m.member_id)
             .select(k.alias("queue_id"), fname.alias("file_name"), "tpa",
                     F.floor(F.col("o_totalprice")).cast("bigint").alias("file_size_bytes"),
                     F.when(st == "F", "SUCCESS").when(st == "P", "FAILED").when(k % 5 == 0, "PROCESSING")
                      .otherwise("PENDING").alias("status"),
                     F.col("o_orderdate").alias("discovered_timestamp"),
                     F.when(st.isin("F", "P"), F.timestamp_add("SECOND", (k % 3600).cast("int"), F.col("o_orderdate")))
                      .alias("processed_timestamp"),
                     (k % 5).cast("int").alias("retry_count"))
             .withColumn("file_type", file_type("file_name")))


def _raw_object():
    """A claim as the JSON object of strings that a raw row carries."""
    fields = ["claim_id", "member_id", "provider_id", "claim_type", "service_date", "diagnosis_code",
              "claim_status", "billed_amount", "allowed_amount", "paid_amount"]
    return F.to_json(F.struct(*[F.col(f).cast("string").alias(f.upper()) for f in fields]))


def raw_rows(spark: SparkSession, d: str, with_ids: bool = True, claim_rows: DataFrame | None = None) -> DataFrame:
    """Bronze raw rows: each claim line as a JSON object of strings in its order's file.

    ``with_ids=False`` skips the record id / row number (not needed for key
    discovery), which saves the sort that numbering requires.  ``claim_rows``: the ``claims`` (numbered if
    ids are wanted) where the caller has them at rest.
    """
    c = _claims(spark, d, with_ids) if claim_rows is None else claim_rows
    k = F.col("order_key")
    suffix = (F.when(k % 4 == 0, ".csv").when(k % 4 == 1, ".CSV.gz").when(k % 4 == 2, ".xlsx").otherwise(".txt"))
    obj = _raw_object()
    if not with_ids:
        return c.select(F.concat(F.col("tpa"), F.lit("/order-"), k.cast("string"), suffix).alias("file_name"),
                        "tpa", obj.alias("raw_data"), file_type(F.concat(F.lit("x"), suffix)).alias("file_type"),
                        F.timestamp_add("SECOND", (k % 3600).cast("int"),
                                        F.col("received_date").cast("timestamp_ntz")).alias("load_timestamp"))
    return c.select(
        "record_id",
        F.concat(F.col("tpa"), F.lit("/order-"), k.cast("string"), suffix).alias("file_name"),
        "file_row_number",
        "tpa", obj.alias("raw_data"),
        file_type(F.concat(F.lit("x"), suffix)).alias("file_type"),
        F.timestamp_add("SECOND", (k % 3600).cast("int"), F.col("received_date").cast("timestamp_ntz")).alias("load_timestamp"),
        F.lit("loader").alias("loaded_by"))


def events(spark: SparkSession, d: str) -> DataFrame:
    return event_rows(table(spark, d, "events"))


def event_rows(e: DataFrame) -> DataFrame:
    """Journey events from raw event rows (batch or streaming frame)."""
    return e.select(
        F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("JRN-"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("journey_id"),
        F.col("user_id").alias("member_id"), "event_type",
        F.col("ts").cast("date").alias("event_date"),
        F.col("value").cast("decimal(18,2)").alias("cost"),
        F.regexp_replace(F.col("props"), "[^0-9]", "").cast("int").alias("provider_id"),
        F.col("event_id").alias("event_seq"))


def journeys(spark: SparkSession, d: str, event_rows: DataFrame | None = None) -> DataFrame:
    e = events(spark, d) if event_rows is None else event_rows
    m = members(spark, d).select("member_id", "tpa")
    last = F.max("event_date")
    return (e.join(m, "member_id")
             .groupBy("journey_id", "member_id", "tpa", "event_type")
             .agg(F.min("event_date").alias("start_date"), last.alias("_last"),
                  F.sum("cost").cast("decimal(18,2)").alias("total_cost"),
                  F.count(F.lit(1)).alias("num_visits"),
                  F.countDistinct("provider_id").alias("num_providers"))
             .select("journey_id", "member_id", "tpa", F.col("event_type").alias("journey_type"), "start_date",
                     F.when(F.col("_last") < F.lit(JOURNEY_OPEN_FROM), F.col("_last")).alias("end_date"),
                     (F.col("_last") >= F.lit(JOURNEY_OPEN_FROM)).alias("is_active"),
                     "total_cost", "num_visits", "num_providers")
             .withColumn("current_stage", F.when(F.col("is_active"), "IN_PROGRESS").otherwise("COMPLETED"))
             .withColumn("quality_score", F.when(~F.col("is_active"), 3 + F.col("num_visits") % 3).cast("int"))
             .withColumn("patient_satisfaction",
                         F.when(~F.col("is_active"), 3 + F.col("num_providers") % 3).cast("int")))


def logs(spark: SparkSession, d: str) -> DataFrame:
    """Application log rows derived from the event stream."""
    e = table(spark, d, "events")
    et = F.col("event_type")
    u = F.col("user_id")
    return e.select(
        F.col("event_id").alias("log_id"), F.col("ts").alias("log_timestamp"),
        F.when(et == "error", "ERROR").when(et == "signup", "WARNING").otherwise("INFO").alias("log_level"),
        F.when(u % 3 == 0, "BRONZE").when(u % 3 == 1, "SILVER").otherwise("GOLD").alias("log_source"),
        F.concat(F.lit("event "), et, F.lit(" user "), u.cast("string")).alias("message"),
        F.col("user_id").alias("user_id"), F.col("value").alias("value"), F.col("props").alias("details"))


def listing(spark: SparkSession, d: str) -> DataFrame:
    """Stage listing: every queued file sits in the stage its status implies."""
    q = queue(spark, d)
    st = F.col("status")
    return q.select(
        F.when(st == "SUCCESS", "COMPLETED").when(st == "FAILED", "ERROR").otherwise("SRC").alias("stage"),
        "file_name", F.col("file_size_bytes").alias("size"),
        F.coalesce("processed_timestamp", "discovered_timestamp").alias("modification_time"))


def errors(spark: SparkSession, d: str) -> DataFrame:
    """Error log: the 'error' events, resolved when their value exceeds 10."""
    return (logs(spark, d).filter(F.col("log_level") == "ERROR")
            .select(F.col("log_id").alias("error_id"), F.col("log_timestamp").alias("error_timestamp"),
                    F.col("log_source").alias("error_source"), F.col("message").alias("error_message"),
                    (F.col("value") > 10).alias("resolved")))


def api_requests(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("request_id"), F.col("ts").alias("log_timestamp"),
                    F.concat(F.lit("/api/"), F.col("event_type")).alias("path"),
                    F.floor(F.col("value") * 100).cast("bigint").alias("latency_ms"))


def task_runs(spark: SparkSession, d: str) -> DataFrame:
    """Task runs: one per queued file, from discovery to processing."""
    q = queue(spark, d)
    return q.select(F.col("queue_id").alias("run_id"), F.concat(F.lit("process_"), F.col("tpa")).alias("task_name"),
                    F.col("discovered_timestamp").alias("start_time"), F.col("processed_timestamp").alias("end_time"),
                    "status")


def file_log(spark: SparkSession, d: str) -> DataFrame:
    """File-processing log: a DISCOVER and a PROCESS row per file."""
    q = queue(spark, d)
    disc = q.select("file_name", "tpa", F.lit("DISCOVER").alias("stage"), F.lit("SUCCESS").alias("status"),
                    F.col("discovered_timestamp").alias("log_timestamp"),
                    F.lit(0).cast("bigint").alias("rows_processed"), F.lit(0).cast("bigint").alias("rows_failed"))
    proc = (q.filter(F.col("status").isin("SUCCESS", "FAILED"))
             .select("file_name", "tpa", F.lit("PROCESS").alias("stage"), "status",
                     F.col("processed_timestamp").alias("log_timestamp"),
                     (F.col("file_size_bytes") % 1000).cast("bigint").alias("rows_processed"),
                     F.when(F.col("status") == "FAILED", F.col("retry_count")).otherwise(0).cast("bigint")
                      .alias("rows_failed")))
    return disc.unionByName(proc)


# -- silver metadata derived from the data ------------------------------------

CLAIM_FIELDS = ["CLAIM_ID", "MEMBER_ID", "PROVIDER_ID", "SERVICE_DATE", "RECEIVED_DATE", "DIAGNOSIS_CODE",
                "CLAIM_STATUS", "BILLED_AMOUNT", "ALLOWED_AMOUNT", "PAID_AMOUNT"]
# Definitions every claims table also declares (column, type, nullable, default);
# the last three carry defaults that do not fit their type.
EXTRA_DEFS = [("CREATED_AT", "TIMESTAMP_NTZ", "N", "CURRENT_TIMESTAMP()"),
              ("PROCESSED_DATE", "TIMESTAMP_NTZ", "Y", None),
              ("SERVICE_YEAR", "NUMBER(4,0)", "Y", "TBD"),
              ("IS_ADJUSTED", "BOOLEAN", "N", "maybe"),
              ("ADJUSTED_DATE", "DATE", "Y", "CURRENT_TIMESTAMP()")]


def claim_strings(spark: SparkSession, d: str, claim_rows: DataFrame | None = None) -> DataFrame:
    """Claims as the string fields a landed file carries, plus the silver table name."""
    c = claims(spark, d) if claim_rows is None else claim_rows
    return c.select(F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("table_name"), "tpa",
                    *[F.col(f.lower()).cast("string").alias(f) for f in CLAIM_FIELDS])


# Whatever reads as a number has this form (most other texts do not, and a cast that fails costs an exception).
_NUMERAL = r"^[\x00-\x20]*[+-]?(?:\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)(?:[eE][+-]?\p{Nd}+)?[\x00-\x20]*$"
# What a value may show, one bit each: it is no number, no date, over 50 and over 100 characters long, null.
_MARKS = ("text", "undated", "over50", "over100", "null")


def _marks(v):
    number = F.when(v.rlike(_NUMERAL), v.try_cast("decimal(18,2)").isNotNull()).otherwise(False)
    shown = [v.isNotNull() & ~number, v.isNotNull() & v.try_cast("date").isNull(), F.length(v) > 50, F.length(v) > 100, v.isNull()]
    return sum((F.when(s, F.lit(1 << i)).otherwise(0) for i, s in enumerate(shown)), F.lit(0))


def claims_profile(spark: SparkSession, d: str, values: bool = True, keys: bool = True) -> DataFrame:
    """What metadata is made from: tpa, claim_type, ``object_keys`` of the raw rows and marks of the landed values (bits, a column per field).

    One pass over the claims, written: mappings, rules, source fields and
    target schemas of one plan read this table, a row per tenant, claim type
    and set of keys.  ``values`` / ``keys`` leave out what the plan has no use for.
    """
    c = claims(spark, d)
    by = ["tpa", "claim_type"]
    if keys:
        c = c.withColumn("object_keys", F.json_object_keys(_raw_object()))
        by = [*by, "object_keys"]
    if not values:
        return written(c.select(*by).distinct(), "claims-profile")
    strings = c.select(*by, *[F.col(f.lower()).cast("string").alias(f"{f}__v") for f in CLAIM_FIELDS])
    # one aggregate a field: a single expression over all of them is more than the JIT takes in
    return written(strings.groupBy(*by).agg(*[F.bit_or(_marks(F.col(f"{f}__v"))).alias(f"{f}__marks") for f in CLAIM_FIELDS]), "claims-profile")


def target_schemas(spark: SparkSession, d: str, profile: DataFrame | None = None) -> DataFrame:
    """Target-schema definitions observed from the landed values of each table.

    Type: NUMBER(18,2) when every value parses as a number, DATE when every
    value parses as a date, else VARCHAR sized to the longest value.
    """
    p = claims_profile(spark, d, keys=False) if profile is None else profile
    g = p.groupBy(F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("table_name")).agg(*[F.bit_or(f"{f}__marks").alias(f"{f}__marks") for f in CLAIM_FIELDS])
    items = []
    for f in CLAIM_FIELDS:
        text, undated, over50, over100, nulls = (F.col(f"{f}__marks").bitwiseAND(F.lit(1 << j)) != 0 for j in range(len(_MARKS)))
        size = F.when(~over50, "50").when(~over100, "100").otherwise("500")
        dtype = (F.when(~text, "NUMBER(18,2)").when(~undated, "DATE")
                  .otherwise(F.concat(F.lit("VARCHAR("), size, F.lit(")"))))
        dflt = (F.when(~text, "0.00").when(~undated, "CURRENT_DATE()").when(~nulls, "N/A")
                 .otherwise(F.lit(None).cast("string")))
        items.append(F.struct(F.lit(f).alias("column_name"), dtype.alias("data_type"),
                              F.when(nulls, "Y").otherwise("N").alias("nullable"), dflt.alias("default_value"),
                              F.lit("Observed " + f.lower()).alias("description")))
    for col, t, n, dv in EXTRA_DEFS:
        items.append(F.struct(F.lit(col).alias("column_name"), F.lit(t).alias("data_type"), F.lit(n).alias("nullable"),
                              F.lit(dv).cast("string").alias("default_value"),
                              F.lit("Declared " + col.lower()).alias("description")))
    return g.select("table_name", F.inline(F.array(*items)))


def _tenant_types(spark: SparkSession, d: str, profile: DataFrame | None = None) -> DataFrame:
    """The (tenant, claim type) pairs in the data; written, as plans read metadata made from them several times."""
    p = claims_profile(spark, d, values=False, keys=False) if profile is None else profile
    return p.select("tpa", "claim_type").distinct()


def field_mappings(spark: SparkSession, d: str, profile: DataFrame | None = None) -> DataFrame:
    """Field mappings per tenant and table present in the data.

    mapping_id is a content formula (tenant key, claim type, field position),
    so no global numbering is needed: it is unique and orders mappings.
    """
    c = _tenant_types(spark, d, profile)
    ranks = F.broadcast(tpa_master(spark, d).select(F.col("tpa_code").alias("tpa"), "tpa_rank"))  # 5 tenants
    c = c.join(ranks, "tpa")
    fields = F.array(*[F.struct(F.lit(i + 1).alias("idx"), F.lit(f).alias("source_field"))
                       for i, f in enumerate(CLAIM_FIELDS)])
    m = c.select("tpa", "tpa_rank", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("target_table"),
                 F.when(F.col("claim_type") == "MEDICAL", 1).when(F.col("claim_type") == "DENTAL", 2)
                  .otherwise(3).alias("type_rank"), F.inline(fields))
    tpa, sf = F.col("tpa"), F.col("source_field")
    manual = tpa.isin("asia", "europe")
    conf = F.when(manual, F.lit(1.0)).otherwise((F.lit(5) + F.length(sf) % 5).cast("double") / 10)
    mid = (F.col("tpa_rank").cast("bigint") * 100000 + F.col("type_rank") * 1000 + F.col("idx")).cast("bigint")
    return m.select(
        mid.alias("mapping_id"), "source_field",
        F.lit("RAW_DATA_TABLE").alias("source_table"), "target_table",
        F.when((tpa == "asia") & (sf == "ALLOWED_AMOUNT"), "PAID_AMOUNT").when(sf == "CLAIM_STATUS", "STATUS")
         .otherwise(sf).alias("target_column"),
        "tpa",
        F.when(manual, "MANUAL").when(tpa == "america", "ML_AUTO").when(tpa == "africa", "LLM_CORTEX")
         .otherwise("FUZZY").alias("mapping_method"),
        conf.alias("confidence_score"), (manual | (conf >= 0.8)).alias("approved"), F.lit(True).alias("active"),
        F.when(sf.like("%AMOUNT"), F.concat(F.lit("TO_NUMBER("), sf, F.lit(")")))
         .when(sf.like("%DATE"), F.concat(F.lit("TO_DATE("), sf, F.lit(")"))).alias("transformation_logic"))


def raw_source_fields(spark: SparkSession, d: str, profile: DataFrame | None = None) -> DataFrame:
    """Distinct object keys of the raw rows per tenant (distinct sets of keys first, then their keys)."""
    p = claims_profile(spark, d, values=False) if profile is None else profile
    return p.select("tpa", F.explode("object_keys").alias("source_field")).distinct()


# Silver rule catalogue: one copy per tenant and claims table found in the
# data.  Fixed values: (rule_id, name, type, target column, logic, action,
# priority, active).  DQ005 is inactive, DQ006 holds an aggregate, DQ007 names
# a column the tables do not have.
RULES = [
    ("DQ001", "Claim ID Not Null", "DATA_QUALITY", "CLAIM_ID", "CLAIM_ID IS NOT NULL", "REJECT", 100, True),
    ("DQ002", "Valid Service Date", "DATA_QUALITY", "SERVICE_DATE", "SERVICE_DATE <= CURRENT_DATE()", "QUARANTINE", 100, True),
    ("DQ003", "Positive Amounts", "DATA_QUALITY", "BILLED_AMOUNT", "BILLED_AMOUNT >= 0", "QUARANTINE", 100, True),
    ("DQ004", "Paid Within Limit", "DATA_QUALITY", "PAID_AMOUNT", "PAID_AMOUNT <= 80000", "FLAG", 110, True),
    ("DQ005", "Huge Bill", "DATA_QUALITY", "BILLED_AMOUNT", "BILLED_AMOUNT > 1000000", "REJECT", 120, False),
    ("DQ006", "Average Bill", "DATA_QUALITY", "BILLED_AMOUNT", "AVG(BILLED_AMOUNT) < 38000", "FLAG", 130, True),
    ("DQ007", "Patient Age", "DATA_QUALITY", "PATIENT_AGE", "PATIENT_AGE >= 0", "REJECT", 140, True),
    ("BL001", "Calculate Discount", "BUSINESS_LOGIC", None, "PAID_AMOUNT / BILLED_AMOUNT AS DISCOUNT_RATE", "FLAG", 200, True),
    ("ST001", "Diagnosis Upper", "STANDARDIZATION", "DIAGNOSIS_CODE", "UPPER(TRIM(DIAGNOSIS_CODE))", "CORRECT", 300, True),
]


def silver_rules(spark: SparkSession, d: str, profile: DataFrame | None = None) -> DataFrame:
    c = _tenant_types(spark, d, profile).select("tpa", F.concat(F.col("claim_type"), F.lit("_CLAIMS")).alias("target_table"))
    items = [F.struct(F.lit(a).alias("rule_id"), F.lit(b).alias("rule_name"), F.lit(t).alias("rule_type"),
                      F.lit(tc).cast("string").alias("target_column"), F.lit(lg).alias("rule_logic"),
                      F.lit(ac).alias("error_action"), F.lit(p).alias("priority"), F.lit(act).alias("active"))
             for a, b, t, tc, lg, ac, p, act in RULES]
    return c.select("tpa", "target_table", F.inline(F.array(*items)))
