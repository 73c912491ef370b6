"""A corpus for training from the table of documents: five stages, each over all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.llm import jaccard, languages, lines, mixing, packing
from contractflow.llm.common import discard, shared_folder, table

#: Least part of a text's trigrams that its language must know; prose mixed with data stays well above it.
LEAST_LANGUAGE = 0.2
#: Near copies share at least so many hundredths of their runs of so many words.
WORDS = 5
PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters or of no known language go."""
    filters = languages.learn(docs.where(~languages.held_out()))
    return languages.known_language(docs, filters, LEAST_LANGUAGE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in one before; those of which nothing is left go."""
    found = lines.dedup_lines(docs)
    left = found.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs, size=WORDS, percent=PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice; one that is cut has its first words."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("line dedup", line_dedup),
    ("near copies", near_copies),
    ("mix", mix),
    ("pack", pack),
]

#: Filters of hashed trigrams, signatures and a tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's result is written as Parquet in the shared folder and read again."""
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            discard(spark, f"{folder}/{number - 1}")  # nothing reads it any more
    return STAGES[-1][1](spark, docs, sf_dir)
