"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote. All but the last return the columns
of `documents`; the last returns the pieces of the packed sequences."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm import language_id, line_dedup, minhash, mixing, packing
from replyscope.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null text, no letter, or no language
    that is at least as likely as all others together. Unlabelled documents get
    the language found."""
    found = language_id.identify(docs, language_id.train(docs))
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that are on more than a tenth of their source's documents."""
    out = line_dedup.drop_boilerplate(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near-duplicates
    (shingles of five words, similarity 0.8 or more)."""
    groups = minhash.near_duplicates(docs)
    dropped = stored(groups.filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct(), "dropped")
    rest = docs.join(dropped, F.col("doc_id").cast("long") == F.col("_dropped"), "left_anti")
    return rest.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some of them twice, so that the sources reach their weights."""
    return mixing.mix(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training, sketches and tokens have no SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
