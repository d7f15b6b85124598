"""What a query leaves on the disk while it runs: shuffle files and work tables of steps that are over."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimlake.llm import jaccard_join
from claimlake.operators.merge import merge_upsert
from claimlake.operators.rules import fuzzy_dedupe
from claimlake.operators.runner import WATERMARKS
from claimlake.operators.store import TableSet
from claimlake.operators.transform import incremental_slice
from claimlake.plans import bindings as b
from claimlake.plans.catalog import queries
from claimlake.session import checkpoint_dir, dropped_shuffles, written


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f and f.endswith(".data")}


def stays(spark, before):
    """Shuffle files that are not yet in ``before``; they go a little after the write."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def work_tables(spark, prefix):
    root = checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(root) if n.startswith(prefix)}


def test_a_written_table_leaves_no_shuffle_files(spark):
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = shuffle_files(spark)
    out = written(df, "scratch-test")
    assert not stays(spark, before)
    assert out.count() == df.count() == 7 and sorted(map(tuple, df.collect())) == sorted(map(tuple, out.collect()))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with dropped_shuffles(spark):
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_jaccard_join_deletes_its_work_tables(spark):
    """regions, texts, comparisons and links of earlier rounds go as soon as nothing reads them."""
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(12)] + [(100 + i, " ".join(f"y{i}z{j}" for j in range(30))) for i in range(5)]
    was = {n: work_tables(spark, f"llm-{n}-") for n in ("regions", "texts", "members", "comparisons", "compared", "rest", "open")}
    out = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {n: work_tables(spark, f"llm-{n}-") - t for n, t in was.items()} == dict.fromkeys(was, set())
    assert {(r.doc_id, r.component_id) for r in out.collect()} == {(i, 0) for i in range(12)} | {(100 + i, 100 + i) for i in range(5)}


def test_a_batch_deletes_its_staged_rows(spark, tmp_path):
    """staged rows go with the end of their batch, also of one that fails."""
    store = TableSet(spark, f"file://{tmp_path}/set")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    before = shuffle_files(spark)
    store.run("B1", lambda b: b.upsert("t", df, ["k"], buckets=4))
    store.run("B2", lambda b: (b.staged("x", df), b.upsert("t", b.staged("t", df.filter("v = 'd'")), ["k"], at_rest=True)))
    with pytest.raises(ZeroDivisionError):
        store.run("B3", lambda b: (b.staged("x", df), 1 // 0))
    assert not [f for _, _, files in os.walk(tmp_path / "set" / "_staged") for f in files]
    assert sorted(map(tuple, store.read("t").collect()), key=str) == [(1, "b"), (2, "e"), (None, "d")]
    assert not stays(spark, before)


def test_a_table_without_rows_takes_no_join(spark, tmp_path):
    """rows were dealt by tenant (five tasks) to meet watermarks that are not there yet."""
    store = TableSet(spark, f"file://{tmp_path}/set")
    raw = spark.createDataFrame([(1, "t"), (2, None)], "record_id long, tpa string")
    new = incremental_slice(raw, store.read("watermarks", WATERMARKS), "S", "T")
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.record_id for r in new.collect()) == [1, 2]
    assert store.read("none", "a int, b struct<x: array<string>>").schema == StructType.fromDDL("a int, b struct<x: array<string>>")


def test_an_upsert_shuffles_each_side_once(spark):
    """the source was shuffled for its deduplication and again for the join."""
    old = spark.createDataFrame([(1, "a", 1), (None, "b", 2), (0, "z", 3)], "k long, v string, w int")
    new = spark.createDataFrame([(1, "c", 1), (1, "d", 0), (None, "e", 5), (None, "a", 9), (7, "x", 7)], "k long, v string, w int")
    out = merge_upsert(old, new, ["k"])
    assert len(re.findall(r"Exchange hashpartitioning", out._jdf.queryExecution().executedPlan().toString())) == 2
    assert sorted(map(tuple, out.collect()), key=str) == [(0, "z", 3), (1, "d", 0), (7, "x", 7), (None, "e", 5)]
    by_w = merge_upsert(old, new, ["k"], order_by=["w", "k"])
    assert sorted(map(tuple, by_w.collect()), key=str) == [(0, "z", 3), (1, "c", 1), (7, "x", 7), (None, "a", 9)]
    mixed = merge_upsert(old, new.withColumn("k", F.col("k").cast("int")), ["k"])
    assert sorted(map(tuple, mixed.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)
    two = merge_upsert(old, new, ["v", "k"])
    assert two.count() == 8 and merge_upsert(old.select("k"), new.select("k"), ["k"]).count() == 4


def test_stored_raw_rows_are_the_raw_rows(spark, sf_dir):
    was = work_tables(spark, "claimlake-claims-joined-")
    raw, pairs = b.stored_raw_rows(spark, sf_dir)
    assert not work_tables(spark, "claimlake-claims-joined-") - was
    assert raw.exceptAll(b.raw_rows(spark, sf_dir)).isEmpty() and raw.count() == b.raw_rows(spark, sf_dir).count()
    assert set(map(tuple, pairs.collect())) == set(map(tuple, b.claims(spark, sf_dir).select("tpa", "claim_type").distinct().collect()))


def test_ingest_leaves_no_shuffles_of_the_claims(spark, sf_dir):
    """the claims' join and their dealing by tenant stayed on the disk while files, lines and raw rows were written."""
    before, was = shuffle_files(spark), work_tables(spark, "claimlake-claims-joined-")
    out = queries()["stream_ingest_counts"](spark, sf_dir)
    for _ in range(50):
        if (size := sum(os.path.getsize(f) for f in shuffle_files(spark) - before)) < 100_000:
            break
        time.sleep(0.1)
    assert size < 100_000 and not work_tables(spark, "claimlake-claims-joined-") - was  # what is left is of small tables: splits, the ledger
    claims = {(r.tpa, r["count"]) for r in b.claims(spark, sf_dir).groupBy("tpa").count().collect()}
    assert {(r.tpa, r.rows) for r in out.collect()} == claims


def test_claim_strings_from_stored_claims(spark, sf_dir):
    got, want = b.claim_strings(spark, sf_dir, b.as_claims(b.stored_claims(spark, sf_dir))), b.claim_strings(spark, sf_dir)
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_fuzzy_dedupe_near_the_threshold(spark, threshold):
    """sketches and marks drop no match, rows whose lowest candidate is no match find a later one, and no words are left to the result's plan."""
    r = random.Random(7)
    rows = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(r.choice([4, 40, 300]))]
        for _ in range(12):
            cut = r.uniform(0, 0.45)
            rows.append((len(rows), "en", " ".join(w if r.random() > cut else f"x{r.randrange(10**6)}" for w in base)))
    r.shuffle(rows)
    sets = {i: set(t.split()) for i, _, t in rows}
    want = {i: min((j for j in sets if j < i and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])), default=None) for i in sets}
    was = {n: work_tables(spark, f"claimlake-{n}-") for n in ("texts", "prefixes", "candidates", "sketches", "marks", "near", "lowest")}
    before = shuffle_files(spark)
    out = fuzzy_dedupe(spark.createDataFrame(rows, "doc_id long, lang string, text string"), "doc_id", "text", threshold, "lang")
    assert not stays(spark, before) and {n: work_tables(spark, f"claimlake-{n}-") - t for n, t in was.items()} == dict.fromkeys(was, set())
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {x.doc_id: x.duplicate_of for x in out.collect()} == want and any(want.values())
