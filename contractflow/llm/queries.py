"""One query per operator, with its production parameters, over the whole of its table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import jaccard, languages, licences, lines, middles, mixing, neighbours, packing, pii, resampling, scoring, sharding, topk
from .common import table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find_pii(table(spark, folder, "documents")))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op3_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score(table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(*mixing.mix(mixing.measured(table(spark, folder, "documents"))))


def op5_languages(spark: SparkSession, folder: str) -> DataFrame:
    return languages.identify_documents(table(spark, folder, "documents"))


def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(sharding.measured(table(spark, folder, "documents")))


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_documents(table(spark, folder, "documents"))


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


def op11_middles(spark: SparkSession, folder: str) -> DataFrame:
    return middles.fill_documents(table(spark, folder, "documents"))


def op12_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(licences.detections(table(spark, folder, "documents")))


def op13_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_scoring": op3_scoring,
    "op4_mixing": op4_mixing,
    "op5_languages": op5_languages,
    "op6_topk": op6_topk,
    "op7_neighbours": op7_neighbours,
    "op8_sharding": op8_sharding,
    "op9_jaccard": op9_jaccard,
    "op10_lines": op10_lines,
    "op11_middles": op11_middles,
    "op12_licences": op12_licences,
    "op13_resampling": op13_resampling,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op4_mixing": mixing.SQL, "op6_topk": topk.SQL, "op11_middles": middles.SQL, "op12_licences": licences.SQL, "op13_resampling": resampling.SQL}
