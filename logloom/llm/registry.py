"""The operators as queries over the given tables, with SQL equivalents where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import capfilters, langid, linededup, mixing, oracles, perplexity, phrases, pieces, prefixtrie, secretscan, sharding, simhash
from logloom.llm import substrings, webpages

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.find_secrets(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_dedup(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webpages.extract(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = perplexity.quality(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "perplexity"
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_sharding": op11_sharding,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = dict(oracles.ORACLES)
