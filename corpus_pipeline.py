"""Corpus pipeline: from raw documents to token ids.

Each stage gets what its predecessor kept, as a Parquet table read again. Documents of
low quality go; one of each group of near duplicates stays; passages that
repeat are cut out of the texts; documents with benchmark passages go; the rest
is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, decontaminate, quality, queries, repeats, simhash
from headway.llm.frames import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=queries.GOOD_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, words=queries.SHINGLE_WORDS, distance=queries.SIMHASH_BITS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text."""
    left = repeats.remove_repeats(docs, length=queries.REPEAT_BYTES)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), size=queries.WINDOW_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens)."""
    ids = bpe.encode(F.col("text"), f"{queries.TOKENIZERS}/byte_bpe_50k.json")
    return docs.select("doc_id", "lang", "source", ids.alias("ids")).withColumn(
        "n_tokens", F.size("ids").cast("bigint")
    )


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("token_ids", encode),
]

#: SQL has neither the trained model nor BPE; tests hold each stage against a
#: plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
