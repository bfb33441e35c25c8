"""A training-data pipeline: five operators in a row, each on all that the one before it kept.

Defined cases, for every stage: rows are told apart by id and text. Columns beyond ``doc_id, text, lang, source`` travel with their row, whatever
their names. An empty table gives an empty table of the same columns (the last stage: of its own).

- quality rules: a null or empty text has no words and goes; a null language is a language of its own; equal rows are judged alike, so all stay or go.
- line dedup: a null text stays empty; a null id is no document that a line could recur in, so such a row keeps its lines.
- near-dedup: the row with the smallest id of a group stays, ids before null, of equal rows one; rows without words are one group.
- mixing: a null source is a source; a row without words is repeated like any other; rows equal in id and text are taken or left together.
- encoding: a null text has no tokens.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import linededup, mixing, perplexity, pieces, simhash
from logloom.llm.text import only_one, without
from logloom.sources.durable import durable, scratch_path, shuffles_released

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or leave their language's perplexity band go."""
    verdicts = perplexity.quality(docs)
    key = F.struct(F.col("doc_id").alias("id"), "h1", "h2").alias("key")
    return without(docs, verdicts.filter("not kept").select(key))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in one document each. Stored here, where little is sent to a Python worker at once."""
    return durable(linededup.dedup_lines(docs).select("row.*", "text").select(*docs.columns), "deduped")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return only_one(docs, simhash.winners(simhash.near_groups(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number of tokens, token ids, and whether decoding gives the text back. Stored here as well; tasks remember and take less than
    in a query of its own, since executors have run other stages before.
    """
    return durable(pieces.encode(docs, cached_words=pieces.CACHED_WORDS // 2, batch_bytes=1 << 20), "tokens")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("sentencepiece", encode),
]

#: The language model and the fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            path = scratch_path(spark, name.replace(" ", "-"))
            with shuffles_released(spark):
                docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
