"""A training corpus from ``documents``: quality, near-duplicates, leaks, mixture, token records.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's rows as Parquet in the shared folder and reads them again for
the next one, so a lost executor repeats no earlier stage.  All stages but the last
return the columns they got.

Nulls in any column, empty and very long texts, ties and repeated rows, empty
tables and extra columns are taken by every stage as its docstring says; a null
text is an empty one, and no stage fails on an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import binary_out, common, decontam, jaccard_join, mixing, quality
from claimlake.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null or empty text has a score like any other; repeated rows share one, so all of them stay or go.  Labels of unknown
    documents are not used; without both labels nothing is preferred and the score is that of the label there is.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, Jaccard 0.75) one document stays: the one with the smallest
    doc_id (a null one only if there is no other), of repeated rows one.  Documents without words are like no other and stay."""
    return jaccard_join.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go. Null and empty texts hold none; an empty benchmark removes nothing."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the target proportions: a document stands as often as the mix takes it.

    A null source is a source of its own; documents without words take part and add none; a source without words
    is not taken; repeated rows are drawn each for itself.
    """
    # the whole row travels as one column, so that no extra column can clash with the mix's own
    rows = docs.select("doc_id", "source", mixing.word_count().alias("size"), F.struct(*docs.columns).alias("__row"))
    return mixing.emit(mixing.mix(rows)).select("__row.*")


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as binary records; one row per record, as read back.

    Null doc_ids come first, equal ones in the order of their texts; a null or empty text is the end id alone.
    """
    path = common.work_path(spark, "corpus")
    binary_out.write_records(docs, path, tokenizer_path())
    index = binary_out.with_start(binary_out.read_index(spark, path))
    back = binary_out.read_records(index, path)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("benchmark decontamination", without_leaks),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", token_records),
]

# A learned score and an edit distance are not for SQL: tests/llm/test_pipeline_llm.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.split()[0])
    return docs
