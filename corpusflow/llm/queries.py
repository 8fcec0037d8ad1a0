"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import bpe, change_points, decontam, hard_negatives, imatch, kd_shards, langid, lm_score, quality_rules, simhash, simple8b, toxicity, url_templates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.report(table(spark, sf_dir, "documents"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents that ``labels`` marks as of good quality."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score.score(table(spark, sf_dir, "documents"), good)


def op9_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.quantised(table(spark, sf_dir, "embeddings"), label=moved), F.col("id") % 100 == 0)


def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.prints_and_edits(table(spark, sf_dir, "documents"))


def op13_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_points.segments(table(spark, sf_dir, "sale_lines"), "vendor_id", "shipped_at", "quantity")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_quality_rules, op2_byte_bpe, op3_kd_shards, op4_url_templates, op5_language_id, op6_simhash, op7_decontamination, op8_lm_score, op9_simple8b, op10_toxicity, op11_hard_negatives, op12_imatch, op13_change_points)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE, "op13_change_points": change_points.ORACLE}
