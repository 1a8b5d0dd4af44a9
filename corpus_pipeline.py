"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage calls one operator of ``lakestrata.llm`` on all rows that the stage before kept; its result is
written as Parquet and read again as the next stage's input. All but the last return the columns of
``documents``; the mix repeats a document as often as it takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm.common import discard, documents, save, saved
from lakestrata.llm.exact_dedup import drop_copies
from lakestrata.llm.language_id import identified
from lakestrata.llm.mixing import mixed_documents
from lakestrata.llm.packing import pack
from lakestrata.llm.simhash import drop_near_copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash_near_dedup", simhash_near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: The trained language model and the packing plan have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = documents(spark, sf_dir), saved()
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(spark, mark)  # the stage's result is stored: nothing reads what it was made of any more
    return STAGES[-1][1](spark, docs, sf_dir)
