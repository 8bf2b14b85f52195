"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

``STAGES`` are (name, function) with function(spark, docs, sf_dir) -> DataFrame.
All but the last return the columns of ``documents``. ``run`` writes what each
stage returns as Parquet to the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontamination, linededup, packing, simhash, toxicity
from tidewater.llm.common import small, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more go. Null and empty texts are scored like any other."""
    model = toxicity.fit(toxicity.sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_documents(docs.select(*COLUMNS), model).where("score < 0.5").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and similar lines go but for the first; documents stay, n_chars follows the text."""
    return (
        linededup.dedup_lines(docs.select(*COLUMNS))
        .withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
        .select(*COLUMNS)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one document stays, that with the smallest doc_id; of rows equal in id and text one."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go, told by a 128-bit key of the text: ids may be null or repeat."""
    key = F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit("text"), "text").alias("y"))
    found = decontamination.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("own")).distinct()
    return docs.select(*COLUMNS, key.alias("own")).join(small(gone), "own", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Compression, fingerprints and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
