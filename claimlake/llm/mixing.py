"""Mixing sources to target weights by systematic sampling.

Sources share a budget (a multiple of all words) by weight, capped at a
multiple of what they hold; within a source every document has the same
expected number of copies (target / source size).  Documents stand in order of
size (ties by a digest of their id), so the prefix sum of expected copies at
the k-th document is k * rate; with one random offset per source a document is
taken once per integer boundary its step crosses.  The order by size spreads
the sample evenly over short and long documents, which keeps the words taken
near the target.

The position k is put together from counts, so that no task holds a source:
documents of smaller sizes in the source, of the same size in earlier digest
buckets, and the position within (source, size, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WEIGHTS = (5, 2, 1)
BUDGET = 1.5   # times all words
CEILING = 2.0  # times a source's words
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING) -> DataFrame:
    """From (source, source_size), one row per source: adds ``target``.

    Weights repeat over the sources by code point, null last.  The level L with
    sum(min(cap, L * weight)) = budget comes from one pass in order of
    cap / weight: a source is capped while its ratio is at most the level that
    the rest would get.  The windows see one row per source, nothing larger.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("__w", w).withColumn("__cap", F.col("source_size") * F.lit(ceiling)).withColumn("__ratio", F.col("__cap") / F.col("__w"))
    order = Window.orderBy("__ratio", F.col("source").isNull(), "source")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (s.withColumn("__budget", F.sum("source_size").over(whole) * F.lit(budget))
         .withColumn("__left", F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
         .withColumn("__level", F.col("__left") / F.sum("__w").over(order.rowsBetween(0, Window.unboundedFollowing))))
    s = s.withColumn("__open", F.min(F.when(F.col("__ratio") > F.col("__level"), F.struct("__ratio", "__level"))).over(whole)["__level"])
    return s.withColumn("target", F.coalesce(F.least("__cap", F.col("__open") * F.col("__w")), "__cap")).select("source", "source_size", "target")


def mix(docs: DataFrame, size: str = "size", weights=WEIGHTS, budget: float = BUDGET, ceiling: float = CEILING, seed: str = SEED) -> DataFrame:
    """All rows of ``docs`` (doc_id, source, ``size``, ...) with ``source_size``, ``target`` and ``copies``.

    No document has more than ceil(ceiling) copies.  Documents of size 0 take
    part and add no words; a source without words has target 0 and no copies;
    null sources are one source; equal doc_ids stand together in any order; an
    empty table gives an empty result.  The offset and the order come from
    digests of seed, source and doc_id, so re-runs and repeated tasks agree.
    """
    d = (docs.drop("source_size", "target", "copies").withColumn("__k", _key("source"))
         .withColumn("__h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("__b", F.substring("__h", 1, 2)))
    by_bucket = d.groupBy("__k", F.col(size).alias("__z"), "__b").agg(F.count(F.lit(1)).alias("__n"), F.first("source").alias("source"))
    by_size = by_bucket.groupBy("__k", "__z").agg(F.sum("__n").alias("__n"), F.first("source").alias("source"))
    by_source = by_size.groupBy("__k").agg(F.sum(F.col("__n") * F.col("__z")).alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(by_source.select("source", "source_size"), weights, budget, ceiling).withColumn("__k", _key("source")).drop("source")
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (by_size.select("__k", "__z", F.coalesce(F.sum("__n").over(earlier("__k", "__z")), F.lit(0)).alias("__n1")).join(targets, "__k"))
    offsets = (by_bucket.select("__k", "__z", "__b", F.coalesce(F.sum("__n").over(earlier("__k", "__z", "__b")), F.lit(0)).alias("__n2"))
               .join(sizes, ["__k", "__z"]))
    within = Window.partitionBy("__k", size, "__b").orderBy("__h", "doc_id")
    placed = (d.withColumn("__i", F.row_number().over(within)).withColumn("__z", F.col(size)).join(offsets, ["__k", "__z", "__b"])
              .withColumn("__i", F.col("__i") + F.col("__n1") + F.col("__n2")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.col("__k"))), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    rate = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    upto = lambda k: F.floor(k * rate + offset)
    placed = placed.withColumn("copies", (upto(F.col("__i")) - upto(F.col("__i") - 1)).cast("int"))
    return placed.drop("__k", "__z", "__h", "__b", "__i", "__n1", "__n2")


def emit(mixed: DataFrame) -> DataFrame:
    """One row per copy; ``copy`` counts from 1."""
    return mixed.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS z, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source),
r AS (SELECT source, z, w, 2.0 * z AS cap, 2.0 * z / w AS ratio, 1.5 * sum(z) OVER () AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, z, CASE WHEN (SELECT count(*) FROM l WHERE ratio > level) = 0 THEN cap
  ELSE least(cap, w * (SELECT arg_min(level, ratio) FROM l WHERE ratio > level)) END AS target FROM l),
k AS (SELECT d.doc_id, d.size, t.z, t.target, row_number() OVER (PARTITION BY d.source ORDER BY d.size, md5(coalesce(d.doc_id::VARCHAR, ''))) AS i,
  ('0x' || substr(md5('mix-1|' || coalesce('s' || d.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z::BIGINT AS source_size, target,
  (size * (floor(i * coalesce(target / nullif(z, 0), 0) + u) - floor((i - 1) * coalesce(target / nullif(z, 0), 0) + u)))::BIGINT AS taken FROM k
"""
