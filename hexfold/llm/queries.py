"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hexfold.llm import clusters, conversations, decontaminate, factorisation, html_text, language, licenses, minhash, mixing, packing, pseudo_likelihood, repeats, tiff
from hexfold.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op3_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_digest(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), VOCABULARY)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clustered(table(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repairs(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pseudo_likelihood, op2_language, op3_tiff, op4_packing, op5_repeats, op6_minhash, op7_quality, op8_decontaminate, op9_licenses, op10_html, op11_mixing, op12_clusters, op13_conversations)}


def oracle_sql() -> dict[str, str]:
    return {"op8_decontaminate": decontaminate.ORACLE_SQL, "op12_clusters": clusters.SQL, "op13_conversations": conversations.SQL}
