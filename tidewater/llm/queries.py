"""The thin queries opN_<name> over the corpus tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontamination, langid, licenses, linededup, oracles, packing, pii, quality, sharding, simhash, toxicity
from tidewater.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(langid.sample(table(spark, sf_dir, "documents")))
    return langid.identify(table(spark, sf_dir, "pages"), model)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op8_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
