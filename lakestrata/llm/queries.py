"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import (
    conversation_repair,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    packing,
    pseudonyms,
    quality_model,
    quality_rules,
    simhash,
    source_divergence,
    suffix_tree_lm,
    warc,
)
from lakestrata.llm.common import documents
from lakestrata.session import shared_dir

#: Key of the registered query; a deployment passes its own secret to pseudonymise().
DEMONSTRATION_KEY = b"lakestrata demonstration key"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_model.quality_scores(documents(spark, sf_dir), labels)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.lm_scores(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)) \
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(documents(spark, sf_dir), DEMONSTRATION_KEY)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_table(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(documents(spark, sf_dir))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = f"{shared_dir(spark, 'llm')}/warc-{uuid.uuid4().hex}"
    warc.write_warc(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"), archive)
    return warc.page_records(warc.read_warc(spark, archive))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_lm_scoring, op3_exact_dedup, op4_license_scan, op5_mixing,
                            op6_pii_pseudonyms, op7_packing, op8_quality_rules, op9_language_id, op10_simhash,
                            op11_conversation_repair, op12_source_divergence, op13_warc)
}
