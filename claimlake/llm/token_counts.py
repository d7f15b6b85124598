"""Token counts through a digest cache.

The cache is a table (content digest, tokenizer digest, tokens) in a shared
folder.  A run digests every text, joins the digests with what the cache has
for this tokenizer, encodes each distinct missing text once and appends the
new counts; then every row gets its count by a join on the digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import common
from claimlake.llm.encoding import encoder, tokenizer_digest

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens bigint"


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer; an absent cache is an empty one."""
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hp.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return spark.createDataFrame([], "digest string, n_tokens bigint")
    return (spark.read.schema(CACHE_SCHEMA).parquet(path).filter(F.col("tokenizer") == tokenizer)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(enc.lengths(b.column("content")), pa.int64())], ["digest", "n_tokens"])
    return run


def normalised(text: str = "text"):
    """The text as the tokenizer sees it (a null text is empty); nothing else
    may change, or the count would."""
    return F.coalesce(F.col(text), F.lit(""))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """All rows and columns of ``docs`` (except the text) with bytes and tokens of their text.

    Nulls count as empty texts (0 tokens); repeated rows and equal texts share
    one digest and are encoded once; an empty table gives an empty result and
    leaves the cache as it is.  Result columns ``n_bytes`` and ``out`` replace
    columns of those names.  Re-runs read the cache and encode nothing; an
    appended digest that two runs both stored is read once.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    content = normalised(text)
    known = read_cache(spark, cache_path, version)
    # copies meet in their map task first, then once by digest; anti join and encoding follow in the same partitions
    distinct = (docs.select(F.sha2(content.cast("binary"), 256).alias("digest"), content.alias("content"))
                .dropDuplicates(["digest"]))
    missing = distinct.join(known.select("digest"), "digest", "left_anti")
    fresh = missing.mapInArrow(_count(tokenizer_path), "digest string, n_tokens bigint")
    fresh.withColumn("tokenizer", F.lit(version)).select("digest", "tokenizer", "n_tokens").write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path, version).withColumnRenamed("n_tokens", "__n").withColumnRenamed("digest", "__digest")
    keep = [c for c in docs.columns if c not in (text, "n_bytes", out)]
    rows = docs.select(*keep, F.octet_length(content).cast("bigint").alias("n_bytes"),
                       F.sha2(content.cast("binary"), 256).alias("__digest"))
    # a digest may be on a third of all rows: a plain equi-join, whose hot side adaptive execution splits
    return rows.join(counts, "__digest", "left").select(*keep, "n_bytes", F.col("__n").alias(out))
