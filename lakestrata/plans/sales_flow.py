"""Bronze sales -> silver (enrich + quality gate) -> gold aggregates + summary document.

The three gold outputs come from ONE scan of silver: a grouping-sets aggregate
((region), (product), ()) with map-side partials, checkpointed to the shared checkpoint
folder (it is a few rows per key) and then split into the outputs.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.quality import QualityError, check_minima
from lakestrata.operators.sales import by_key_from_rollup, enrich_sales, sales_rollup
from lakestrata.plans.lake import (
    Lake, _fs, append_lineage, append_ops, lineage_record, literal, read_layer, write_gold, write_partition,
)
from lakestrata.plans.landing import stage
from lakestrata.plans.summary import write_summaries
from lakestrata.session import shared_dir


GATED = ("quantity", "unit_price")


def bronze_to_silver(spark: SparkSession, lake: Lake, partition: str, now=None,
                     bronze: DataFrame | None = None) -> int:
    """K3 + P6 + X1: enrich one bronze partition, gate it, write the silver partition.

    One scan of bronze: the rows are written aside while their minima are observed, and moved in only if the
    gate passes. A failed gate raises and leaves the silver partition as it was.
    """
    if bronze is None:
        bronze = read_layer(spark, lake, "bronze", "sales", schemas.BRONZE["sales"], "partition",
                            partition=partition)
    silver = enrich_sales(bronze.select(*schemas.BRONZE["sales"].fieldNames()), now)
    staged, path = stage(silver, lake, "sales", partition, GATED), lake.path("silver", "sales")
    try:
        check_minima([staged.minima], GATED)
    except QualityError:
        staged.discard()
        raise
    staged.publish(path)
    append_lineage(spark, lake, [lineage_record(
        "silver", path, dataset="sales", partition=partition, source_layer="bronze",
        source_path=lake.path("bronze", "sales"), record_count=staged.rows,
        extra={"transformations": "calculate_total_amount,add_processed_at"})])
    return staged.rows


def passes(columns: Sequence[str] = GATED) -> Column:
    """X1 on a row of minima: every gated column has a positive minimum (none at all fails)."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(f"min_{c}") > 0, F.lit(False)) for c in columns])


def gate_partitions(silver: DataFrame, lake: Lake, verdict_path: str) -> DataFrame:
    """X1 + K3 for many partitions at once: the partitions of ``silver`` (enriched rows with ``partition``)
    that pass the gate replace theirs in the lake, the others leave it alone.

    Returns the verdict, stored at ``verdict_path``: partition, min_quantity, min_unit_price, rows, good.
    The rows are evaluated once, by the write aside; minima and counts are read back from its files.
    """
    spark = silver.sparkSession
    staged = stage(silver, lake, "sales", F.col("partition"))
    staged.per_partition(GATED).withColumn("good", passes()).coalesce(1).write.mode("overwrite").parquet(verdict_path)
    verdict = spark.read.parquet(verdict_path)
    failed = {r.partition for r in verdict.where(~F.col("good")).select("partition").collect()}  # names only
    staged.publish(lake.path("silver", "sales"), lambda p: p not in failed)
    return verdict


def silver_to_gold(spark: SparkSession, lake: Lake, partition: str, report_date=None,
                   now=None) -> dict:
    """A1-A4 + K4/K5 for one silver partition."""
    silver = read_layer(spark, lake, "silver", "sales", schemas.SILVER_SALES, "partition", partition=partition)
    shared_dir(spark, "rollups")  # makes sure a reliable checkpoint folder is configured
    rollup = sales_rollup(silver.drop("partition")).checkpoint(eager=True)
    out = {}
    for key in ("region", "product"):
        out[f"sales_by_{key}"] = write_gold(by_key_from_rollup(rollup, key, report_date), lake,
                                            f"sales_by_{key}", partition, ["sales"], source_layer="silver",
                                            extra={"aggregation": f"by_{key}"}).rows
    out["daily_summary"] = write_summaries(rollup, lake, report_date, now, partition)
    append_lineage(spark, lake, [lineage_record(
        "gold", out["daily_summary"], dataset="daily_summary", partition=partition, source_layer="silver",
        source_path=lake.path("silver", "sales"), record_count=1, source_tables=["sales"])])
    return out


def run_sales_flow(spark: SparkSession, lake: Lake, partition: str, report_date=None,
                   now: _dt.datetime | None = None) -> dict:
    rows = bronze_to_silver(spark, lake, partition, now)
    gold = silver_to_gold(spark, lake, partition, report_date, now)
    return {"silver_rows": rows, **gold}


def write_bronze_sales(df: DataFrame, lake: Lake, partition_col: F.Column | None = None,
                       partition: str | None = None, source: str = "erp_system",
                       now: _dt.datetime | None = None) -> int:
    """K2 + K6: land ERP sales rows in bronze (one partition, or one per value of ``partition_col``) with a
    lineage record per written partition. Returns the rows written.

    The input is evaluated once. The counts of a landing in many partitions are read back from the footers of
    the files it wrote, and go from there to the lineage table without passing the driver.
    """
    spark, path = df.sparkSession, lake.path("bronze", "sales")
    if partition_col is None:
        res = write_partition(df, path, partition)
        append_lineage(spark, lake, [lineage_record(
            "bronze", path, dataset="sales", partition=partition, record_count=res.rows, written_at=now,
            extra={"source": source})] if res.rows else [])
        return res.rows
    staged = stage(df, lake, "bronze-sales", partition_col)
    counts = f"{staged.path}-counts"
    staged.per_partition().coalesce(1).write.parquet(counts)
    staged.publish(path)
    if staged.rows:
        same = lineage_record("bronze", path, dataset="sales", written_at=now, extra={"source": source})
        own = {"partition": F.col("partition"), "record_count": F.col("rows")}
        landed = spark.read.schema("partition string, rows long").parquet(counts).select(
            *[own.get(f.name, literal(same[f.name], f.dataType)).alias(f.name) for f in schemas.LINEAGE.fields])
        append_ops(landed, lake.lineage, "written_at")
    fs, p = _fs(spark, counts)
    fs.delete(p, True)
    return staged.rows
