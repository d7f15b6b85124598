import os
import shutil

from pyspark.sql import functions as F

from claimlake.plans import bindings as b
from claimlake.plans import stream_plans
from claimlake.streaming import ingest


def test_stream_journeys_equals_batch(spark, sf_dir):
    s = {r.journey_id: (r.event_count, r.total_cost) for r in stream_plans.stream_journeys(spark, sf_dir).collect()}
    e = b.events(spark, sf_dir)
    batch = {r.journey_id: (r.n, r.c) for r in
             e.groupBy("journey_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("c")).collect()}
    assert s == batch


def test_stream_ingest_counts_match_claims(spark, sf_dir):
    got = {r.tpa: r.rows for r in stream_plans.stream_ingest_counts(spark, sf_dir).collect()}
    want = {r.tpa: r["count"] for r in b.claims(spark, sf_dir).groupBy("tpa").count().collect()}
    assert got == want


def test_stream_ingest_replay_is_harmless(spark, tmp_path, fixtures_dir):
    root = tmp_path / "landing"
    shutil.copytree(os.path.join(fixtures_dir, "landing"), root)
    raw = str(tmp_path / "raw")
    ingest.stream_ingest(spark, str(root), raw, str(tmp_path / "ck"))
    n1 = spark.read.parquet(raw).count()
    # a new checkpoint replays every file: nothing is loaded twice
    ingest.stream_ingest(spark, str(root), raw, str(tmp_path / "ck2"))
    assert spark.read.parquet(raw).count() == n1 == 6


def test_stream_counts_many_providers_exactly(spark, tmp_path):
    from claimlake.streaming import journeys
    ev = (spark.range(6000).withColumns({
        "journey_id": F.concat(F.lit("J"), (F.col("id") % 3).cast("string")), "cost": F.lit("1.25").cast("decimal(18,2)"),
        "provider_id": F.when(F.col("id") % 3 < 2, (F.col("id") % 1701).cast("int")),
        "event_date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int"))}))
    for part in range(3):  # the same providers come again in later files
        ev.filter(F.col("id") % 7 % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    raw = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    root = str(tmp_path / "table")
    journeys.stream_journey_metrics(spark, raw, root, str(tmp_path / "ck"))
    got = {r.journey_id: tuple(r) for r in journeys.read_journeys(spark, root).collect()}
    want = {r.journey_id: tuple(r) for r in ev.groupBy("journey_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("cost").cast("decimal(28,2)").alias("total_cost"), F.countDistinct("provider_id").alias("provider_count"),
        F.min("event_date").alias("first_event"), F.max("event_date").alias("last_event")).collect()}
    assert got == want and {k: v[3] for k, v in got.items()} == {"J0": 567, "J1": 567, "J2": 0}


def test_a_stream_batch_rewrites_its_buckets_only(spark, tmp_path):
    from claimlake.operators.store import TableSet
    from claimlake.streaming import journeys
    store = TableSet(spark, f"file://{tmp_path}/set")
    ev = spark.range(400).withColumns({"journey_id": F.concat(F.lit("J"), (F.col("id") % 100).cast("string")), "cost": F.lit("2.00").cast("decimal(18,2)"),
                                       "provider_id": (F.col("id") % 7).cast("int"), "event_date": F.lit("2024-01-01").cast("date")})
    assert journeys.upsert_batch(store, journeys.provider_metrics_stream(ev), "0", buckets=8)
    pairs, table = set(store.parts("pairs")), set(store.parts("journeys"))
    one = journeys.provider_metrics_stream(ev.filter("journey_id = 'J5'").unionByName(ev.filter("id = 5").withColumn("provider_id", F.lit(99))))
    assert journeys.upsert_batch(store, one, "1") and not journeys.upsert_batch(store, one, "1")
    assert len(pairs - set(store.parts("pairs"))) == 1 and len(table - set(store.parts("journeys"))) == 1
    got = {r.journey_id: (r.event_count, r.provider_count) for r in store.read("journeys").collect()}
    assert len(got) == 100 and got["J5"] == (5, 5) and got["J6"] == (4, 4)


def test_stream_with_a_watermark_keeps_totals(spark, tmp_path):
    from claimlake.streaming import journeys
    ev = (spark.range(300).withColumns({"journey_id": F.concat(F.lit("J"), (F.col("id") % 3).cast("string")), "cost": F.lit("1.00").cast("decimal(18,2)"), "provider_id": (F.col("id") % 4).cast("int"),
                                        "event_date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int"))}))
    for part in range(3):
        ev.filter(F.floor(F.col("id") / 100) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    raw = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    journeys.stream_journey_metrics(spark, raw, str(tmp_path / "table"), str(tmp_path / "ck"), watermark="400 days", buckets=2)
    got = {r.journey_id: (r.event_count, r.provider_count) for r in journeys.read_journeys(spark, str(tmp_path / "table")).collect()}
    assert got == {"J0": (100, 4), "J1": (100, 4), "J2": (100, 4)}


def test_ingest_after_a_crash_between_files(spark, tmp_path, fixtures_dir, monkeypatch):
    root, raw = tmp_path / "landing", str(tmp_path / "raw")
    shutil.copytree(os.path.join(fixtures_dir, "landing"), root)
    (root / "provider_a" / "empty.csv").write_text("A,B\n")
    paths = sorted(f"file://{p}" for p in root.rglob("*.csv*"))
    real = ingest.TableSet.run

    def dies(self, batch_id, build):
        raise RuntimeError("lost after some part files")
    monkeypatch.setattr(ingest.TableSet, "run", dies)
    try:
        ingest.ingest_batch(spark, f"file://{root}", raw, paths, 0)
    except RuntimeError:
        pass
    left = [d for d in os.listdir(raw) if d.startswith("batch_id=")]
    assert len(left) == 1 and ingest.read_ledger(spark, raw).count() == 0
    monkeypatch.setattr(ingest.TableSet, "run", real)
    assert ingest.ingest_batch(spark, f"file://{root}", raw, paths, 0) == len(paths)
    assert not os.path.exists(f"{raw}/{left[0]}") and spark.read.parquet(raw).count() == 6
    book = {r.file_name: (r.status, r.rows_loaded) for r in ingest.read_ledger(spark, raw).collect()}
    assert len(book) == len(paths) and sum(n for _, n in book.values()) == 6 and book["provider_a/empty.csv"] == ("EMPTY", 0)
    assert ingest.ingest_batch(spark, f"file://{root}", raw, paths, 1) == 0 and spark.read.parquet(raw).count() == 6


def test_ingest_sorts_no_lines(spark, sf_dir, tmp_path, fixtures_dir, monkeypatch):
    """files are written unsorted, and lines meet what is known of their split without a sort by split."""
    from pyspark.sql import DataFrameWriter
    from claimlake.sources import landing
    seen, key = [], "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    for kind in ("csv", "parquet"):
        real = getattr(DataFrameWriter, kind)
        monkeypatch.setattr(DataFrameWriter, kind, lambda w, path, *a, _real=real, _kind=kind, **k: (
            seen.append((_kind, int(w._spark.conf.get(key)))) if "landing" in path[-8:] or "/batch_id=" in path else None, _real(w, path, *a, **k))[1])
    stream_plans.stream_ingest_counts(spark, sf_dir)
    assert {k for k, n in seen if n > 1} == {"csv", "parquet"} and all(n > 1 for _, n in seen)
    assert spark.conf.get(key) == before
    rows = landing.read_landing_csv(spark, os.path.join(fixtures_dir, "landing"), work=str(tmp_path / "lines"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
