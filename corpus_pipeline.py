"""A corpus pipeline: quality, near-duplicates, repeated passages, benchmark passages, packing.

Every stage takes the columns of ``documents`` and all but the last return
them.  The near-duplicate and the benchmark stage name rows by a key of doc_id
and text, so that rows that share a doc_id, and rows without one, are judged
each by its own text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexfold.llm import decontaminate, factorisation, minhash, packing, repeats
from hexfold.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine does not reject."""
    model = factorisation.quality_model(docs, table(spark, sf_dir, "labels"))
    return factorisation.scored(docs, model, COLUMNS).filter("score >= 0.5").select(*COLUMNS)


def row_key() -> Column:
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, 0.8): the least doc_id, none last."""
    keyed = docs.select(*COLUMNS).withColumn("_key", row_key())
    made = minhash.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id")
    ids = keyed.groupBy("_key").agg(F.first("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    rows = written(made.distinct().join(ids, "_key"), "rows")
    order = F.struct(F.col("id").isNull(), "id", "_key")
    groups = rows.groupBy("component_id").agg(F.min_by("_key", order).alias("_key"), F.count(F.lit(1)).alias("members"))
    stay = groups.select("_key")
    gone = rows.join(groups.filter("members > 1").select("component_id"), "component_id", "left_semi").select("_key").join(stay, "_key", "left_anti")
    again = rows.filter("n > 1").select("_key")
    once = keyed.join(gone.union(again), "_key", "left_anti")
    first = keyed.join(again.join(stay, "_key", "left_semi"), "_key", "left_semi").dropDuplicates(["_key"])
    return once.select(*COLUMNS).union(first.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of over 50 words that start elsewhere too, whatever their bytes."""
    out = repeats.cut(docs.withColumn("_text", F.col("text")), "_text", tuple(COLUMNS), repeats.PASSAGES)
    cut = F.col("n_removed") > 0
    out = out.withColumn("text", F.when(cut, F.col("kept").cast("string")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    keyed = docs.select(*COLUMNS).withColumn("_key", row_key())
    leaks = decontaminate.contained(keyed.select(F.col("_key").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return keyed.join(leaks.select(F.col("doc_id").alias("_key")).distinct(), "_key", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of windows of 2048 ids."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("packing", packed),
]
#: learned rejection and hashed sketches have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
