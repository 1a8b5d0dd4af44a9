"""The daily summary document, with breakdowns of any width (K5, A3, A4).

A partition's summary is one index record (a JSON object with the totals) and the entries of its breakdowns by
region and by product in pieces: JSON objects of at most ``PIECE_KEYS`` entries, range-sorted by key, each with
its first and last key, so a reader finds a key without reading the others. A breakdown that fits one piece is
also in the index record, as the map readers of the plain document expect; a wider one is only counted there.
No row and no task holds more than one piece, whatever the number of products::

    {root}/gold/daily_summary/partition=P/...          one index record
    {root}/gold/daily_summary_pieces/partition=P/...   one line per piece

Pieces and index carry the id of the run that wrote them, so pieces of an earlier run are never mixed in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.sales import REVENUE, summary_scalars
from lakestrata.plans.lake import Lake

PIECE_KEYS = 10_000
SECTIONS = ("by_region", "by_product")
PIECES = schemas._struct(("run", schemas.S), ("section", schemas.S), ("first_key", schemas.S), ("last_key", schemas.S),
                         ("n", schemas.L), ("entries", schemas.GOLD["daily_summary"]["by_product"].dataType), ("partition", schemas.S))


def summary_pieces(rollup: DataFrame, piece_keys: int = PIECE_KEYS) -> DataFrame:
    """section, first_key, last_key, n, entries, partition from a roll-up with ``partition``.

    A range sort deals the entries out; rows are numbered inside their task and cut every ``piece_keys``.
    """
    order = ["partition", "section", "key"]
    entries = rollup.where(F.col("grouping") != "total").select(
        "partition", F.concat(F.lit("by_"), F.col("grouping")).alias("section"), "key", "total_revenue")
    at = F.monotonically_increasing_id()
    placed = entries.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at)
    piece = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / piece_keys)
    listed = F.sort_array(F.collect_list(F.struct("key", "total_revenue")))
    return placed.groupBy("partition", "section", F.shiftright("at", 33).alias("task"), piece.alias("piece")).agg(
        F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("n"),
        F.map_from_entries(listed).alias("entries")) \
        .select("section", "first_key", "last_key", "n", "entries", "partition")


def _index(scalars: DataFrame, pieces: DataFrame, piece_keys: int) -> DataFrame:
    """Index records: the scalars, the maps of narrow breakdowns, the pieces and entries of each."""
    counts = pieces.groupBy("partition", "section").agg(F.sum("n").alias("keys"), F.count(F.lit(1)).alias("pieces"))
    narrow = pieces.join(counts.where(F.col("keys") <= piece_keys).select("partition", "section"), ["partition", "section"]) \
        .groupBy("partition", "section").agg(F.map_from_entries(F.sort_array(F.flatten(F.collect_list(
            F.map_entries("entries"))))).alias("entries"))
    facts = counts.join(narrow, ["partition", "section"], "left")

    def of(section: str, column: str):
        return F.max_by(column, F.when(F.col("section") == section, 1))

    wide = facts.groupBy("partition").agg(*[of(s, c).alias(f"{s}_{c}") for s in SECTIONS
                                            for c in ("entries", "keys", "pieces")])
    empty = F.create_map().cast(f"map<string,{REVENUE}>")
    maps = [F.when(F.col(f"{s}_keys").isNull(), empty).otherwise(F.col(f"{s}_entries")).alias(s) for s in SECTIONS]
    sizes = [F.coalesce(F.col(f"{s}_{c}"), F.lit(0)).alias(f"{s}_{c}") for s in SECTIONS for c in ("keys", "pieces")]
    return scalars.join(wide, "partition", "left").select(*scalars.columns, *maps, *sizes)


def write_summaries(rollup: DataFrame, lake: Lake, report_date=None, now=None, partition: str | None = None,
                    piece_keys: int = PIECE_KEYS) -> str:
    """Write the summaries of the partitions of ``rollup`` (its column ``partition``, or the one named).

    The roll-up is read three times, so callers pass a stored one. A named partition without any
    rows gets a zero summary.
    """
    spark, run = rollup.sparkSession, uuid.uuid4().hex
    scalars = summary_scalars(rollup, report_date, now, by=None if partition else "partition", partition=partition)
    placed = rollup.withColumn("partition", F.lit(partition)) if partition else rollup
    path = lake.path("gold", "daily_summary_pieces")
    summary_pieces(placed, piece_keys).withColumn("run", F.lit(run)) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition").json(path)
    pieces = spark.read.schema(PIECES).json(path).where(F.col("run") == run)
    index = _index(scalars, pieces, piece_keys).withColumn("run", F.lit(run))
    target = lake.path("gold", "daily_summary")
    if partition:  # the record names its partition, as the folder does
        target = f"{target}/partition={partition}"
        index.coalesce(1).write.mode("overwrite").json(target)
    else:
        index.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition").json(target)
    return target


def read_summary_index(spark: SparkSession, lake: Lake) -> DataFrame:
    """The index records of all partitions."""
    counts = [(f"{s}_{c}", "bigint") for s in SECTIONS for c in ("keys", "pieces")]
    fields = schemas.with_fields(schemas.GOLD["daily_summary"], *counts, ("run", "string"), ("partition", "string"))
    return spark.read.schema(fields).json(lake.path("gold", "daily_summary"))


def read_breakdowns(spark: SparkSession, lake: Lake) -> DataFrame:
    """partition, section, key, total_revenue: the pieces of every summary's own run, joined."""
    runs = read_summary_index(spark, lake).select("partition", "run")
    pieces = spark.read.schema(PIECES).json(lake.path("gold", "daily_summary_pieces"))
    return pieces.join(runs, ["partition", "run"], "left_semi") \
        .select("partition", "section", F.explode("entries").alias("key", "total_revenue"))

