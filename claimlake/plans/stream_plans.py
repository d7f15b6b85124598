"""Registered plans over files and streams (SRC-1..3, BRZ-5, BRZ-8, BRZ-33, JRN-13).

Each call runs its stream to completion (``availableNow``) in a fresh folder
under the session's checkpoint directory and returns the resulting table.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from claimlake.plans import bindings as b
from claimlake.plans.registry import register
from claimlake.session import checkpoint_dir, discard, dropped_shuffles, open_files
from claimlake.sources import landing
from claimlake.sources.tables import table
from claimlake.streaming import ingest, journeys


def _scratch(spark, name: str) -> str:
    return checkpoint_dir(spark).rstrip("/") + f"/claimlake-{name}-{uuid.uuid4().hex[:12]}"


@register("stream_journeys", views=("v_event",), oracle="""
select journey_id, count(*) as event_count, cast(sum(cost) as decimal(28,2)) as total_cost, count(distinct provider_id) as provider_count,
 min(event_date) as first_event, max(event_date) as last_event from v_event group by journey_id""")
def stream_journeys(spark, d):
    base = _scratch(spark, "journeys")
    raw = spark.read.parquet(os.path.join(d, "events.parquet"))
    # the file source needs a folder: the data folder, filtered to the one table
    ev = b.event_rows(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
                      .option("pathGlobFilter", "events.parquet").parquet(d))
    journeys.stream_journey_metrics(spark, ev, base + "/table", base + "/checkpoint")
    return journeys.read_journeys(spark, base + "/table")


@register("stream_ingest_counts", views=("v_claim",), oracle="""
select tpa, count(*) as rows, cast(1 as bigint) as files, 'SUCCESS' as status from v_claim group by tpa""")
def stream_ingest_counts(spark, d):
    """Claim lines written as landing CSVs (one folder per tenant), then streamed into raw."""
    base = _scratch(spark, "ingest")
    c = b.stored_claims(spark, d)  # the join's shuffles are gone when the lines are dealt by tenant; a line becomes text after that
    with open_files(spark), dropped_shuffles(spark):  # a tenant's file is one task's stream, which must not sort the tenant's lines first
        (b.claim_strings(spark, d, b.as_claims(c.repartition("tpa"))).write.partitionBy("tpa").option("header", True).mode("overwrite")
          .csv(base + "/landing"))
    discard(c)
    ingest.stream_ingest(spark, base + "/landing", base + "/raw", base + "/checkpoint", partition_dirs=True)
    raw = spark.read.parquet(base + "/raw").groupBy("tpa").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("file_name").alias("files"))
    files = ingest.read_ledger(spark, base + "/raw").groupBy("tpa").agg(F.sum("rows_loaded").alias("rows"), F.count(F.lit(1)).alias("files"), F.max("status").alias("status"))
    return raw.join(files, ["tpa", "rows", "files"])  # raw rows and ledger agree


def _landed_documents(spark, d, base: str) -> str:
    """All documents as landing CSVs: a folder per source, plain files and gzip ones, cells over many lines, two header layouts."""
    c = table(spark, d, "documents").select(F.coalesce("source", F.lit("none")).alias("folder"), F.col("doc_id").alias("DOC_ID"), "lang",
                                            F.col("text").alias("FULL TEXT"), F.col("n_chars").cast("string").alias("n_chars"))
    csv = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    even = F.pmod(F.col("DOC_ID"), F.lit(2)) == 0
    c.filter(even).write.partitionBy("folder").options(**csv).csv(base + "/landing/a")
    c.filter(~even).select("FULL TEXT", "DOC_ID", F.col("lang").alias("LANGUAGE"), "folder").write.partitionBy("folder").options(compression="gzip", quoteAll=True, **csv).csv(base + "/landing/b")
    return base + "/landing"


@register("landing_rows", oracle=r"""
select case when doc_id % 2 = 0 then 'a' else 'b' end as tpa, coalesce(source, 'none') as folder, cast(doc_id as varchar) as doc_id,
 nullif(lang, '') as lang, nullif(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '') as text, true as dense,
 case when doc_id % 2 = 0 then '["DOC_ID","lang","FULL TEXT","n_chars"]' else '["FULL TEXT","DOC_ID","LANGUAGE"]' end as keys
from documents""")
def landing_rows(spark, d):
    """Documents written as CSV files of two layouts and read back; ``dense``: the file's rows are numbered 1 to their count."""
    root = _landed_documents(spark, d, _scratch(spark, "landed"))
    rows = landing.read_landing_csv(spark, root)
    files = rows.groupBy("file_name").agg((F.max("file_row_number") == F.count(F.lit(1))).alias("_full"), (F.min("file_row_number") == 1).alias("_one"),
                                          (F.sum("file_row_number") * 2 == F.count(F.lit(1)) * (F.count(F.lit(1)) + 1)).alias("_sum"))
    get = lambda *keys: F.coalesce(*[F.from_json("raw_data", "map<string,string>")[k] for k in keys])
    return rows.join(files, "file_name").select("tpa", F.regexp_extract("file_name", "folder=([^/]*)/", 1).alias("folder"), get("DOC_ID").alias("doc_id"), get("lang", "LANGUAGE").alias("lang"),
                                                get("FULL TEXT").alias("text"), (F.col("_full") & F.col("_one") & F.col("_sum")).alias("dense"),
                                                F.to_json(F.json_object_keys("raw_data")).alias("keys"))


@register("landing_outcomes", oracle="""
select case when doc_id % 2 = 0 then 'a' else 'b' end as tpa, cast(count(*) as bigint) as rows_read, cast(0 as bigint) as uneven, 'SUCCESS' as status
from documents group by 1""")
def landing_outcomes(spark, d):
    files = landing.landing_outcomes(spark, _landed_documents(spark, d, _scratch(spark, "outcomes")))
    return files.groupBy("tpa").agg(F.sum("rows_read").alias("rows_read"), F.sum(F.col("short_rows") + F.col("long_rows")).alias("uneven"), F.max(F.split_part("result", F.lit(":"), F.lit(1))).alias("status"))
