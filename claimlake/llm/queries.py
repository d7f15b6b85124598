"""The registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import binary_out, bpe, common, decontam, embed_dedup, html_extract, jaccard_join, labelled, license_scan, mixing, prefix_trie, quality, structure_repair, token_counts, toxicity
from claimlake.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.main_text(pages, html_extract.learn(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document, within the edit budget; one row per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontam.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("bigint").alias("n_items"),
                      F.col("leaks.item_id").alias("item_ids"), F.array_min("leaks.edits").alias("edits"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all documents; the words that each document gives to the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size"))
    mixed = mixing.mix(common.stored(docs, "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of all documents; toxic where grade 1 or more is likelier than grade 0."""
    docs = table(spark, sf_dir, "documents")
    got = toxicity.graded(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return got.select("doc_id", "severity", "grade", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of all embeddings: cosine 0.93 within a label."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 5-word shingles, Jaccard 0.75."""
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = quality.scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return got.select("doc_id", labelled.held_out().alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans all documents for license phrases and for blocks like license templates."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents, writes the records, reads the files back; one row per document."""
    path = common.work_path(spark, "records")
    binary_out.write_records(table(spark, sf_dir, "documents"), path, tokenizer_path())
    index = binary_out.with_start(binary_out.read_index(spark, path))
    back = binary_out.read_records(index, path)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the tokens of all documents through a digest cache (a new one for each call)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = token_counts.token_counts(docs, tokenizer_path(), common.work_path(spark, "token-cache"))
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants faults in all conversations and finds their cheapest repairs; one row per conversation."""
    return structure_repair.audited(structure_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations' prefixes, after their openings were spliced; one row per node."""
    turns = common.stored(prefix_trie.numbered(prefix_trie.turn_digests(table(spark, sf_dir, "conversations"))), "turns")
    return prefix_trie.trie(*prefix_trie.spliced(turns))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents by the rank table and decodes them again; one row per document."""
    import public_tokenizers
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(RANKS), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_decontaminate": op2_decontaminate,
    "op3_mixing": op3_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality": op7_quality,
    "op8_license_scan": op8_license_scan,
    "op9_binary_records": op9_binary_records,
    "op10_token_counts": op10_token_counts,
    "op11_structure_repair": op11_structure_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_bpe": op13_bpe,
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.ORACLE,
    "op8_license_scan": license_scan.ORACLE,
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
