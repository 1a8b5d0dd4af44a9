"""Checks of a lake: bronze partition audit and the verification report.

Everything is computed from per-partition summaries: row counts come from Parquet footers
(only the ``partition`` / ``batch_id`` folder columns are read), states from the sync log.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators import quality
from lakestrata.plans import synclog
from lakestrata.plans.ingest import committed_batches
from lakestrata.plans.lake import Lake, exists, read_lineage, rows_frame
from lakestrata.specs import CLIENT_TABLES

_COUNTS = schemas._struct(("table_name", schemas.S), ("partition", schemas.S), ("record_count", schemas.L))
_PAIRS = schemas._struct(("table_name", schemas.S), ("partition", schemas.S))


def _union(frames: list[DataFrame], spark: SparkSession, schema) -> DataFrame:
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def bronze_partition_counts(spark: SparkSession, lake: Lake, tables: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(readable, on-disk) rows per (table_name, partition); readable = committed, live batches."""
    readable, raw = [], []
    for t in tables:
        path = lake.path("bronze", t)
        if not exists(spark, path):
            continue
        # folder columns only; a landing folder without batches (e.g. ERP sales files) has null batch ids
        files = spark.read.schema("partition string, batch_id string").parquet(path)
        per_batch = files.groupBy("partition", "batch_id").agg(F.count(F.lit(1)).alias("n"))
        committed = committed_batches(spark, lake, t).withColumn("_live", F.lit(True))
        live = per_batch.join(committed, "batch_id", "left").where(F.col("_live") | F.col("batch_id").isNull())
        for frames, df in ((readable, live), (raw, per_batch)):
            frames.append(df.groupBy("partition").agg(F.sum("n").cast("bigint").alias("record_count"))
                          .select(F.lit(t).alias("table_name"), "partition", "record_count"))
    return _union(readable, spark, _COUNTS), _union(raw, spark, _COUNTS)


def audit_bronze(spark: SparkSession, lake: Lake, tables: Sequence[str] | None = None,
                 partitions: Sequence[str] | None = None) -> DataFrame:
    """X2 for a lake: status of each (table, partition) of ``tables`` (default: all client tables).

    Expected pairs are every table x ``partitions`` when given, else every partition the
    sync log committed or a folder holds. MISSING: no readable folder; ERROR: rows on disk
    but none committed; EMPTY / OK by readable row count; metadata_missing: no lineage record.
    """
    names = list(tables) if tables is not None else [s.target_table for s in CLIENT_TABLES]
    readable, raw = bronze_partition_counts(spark, lake, names)
    if partitions is not None:
        expected = rows_frame(spark, [{"table_name": t, "partition": p} for t in names for p in partitions], _PAIRS)
    else:
        logged = (synclog.read_log(spark, lake, whole=True)
                  .where(F.col("table_name").isin(*names) & (F.col("status") == "ok") & F.col("partition").isNotNull())
                  .select("table_name", "partition"))
        expected = logged.unionByName(raw.select("table_name", "partition"))
    lineage = read_lineage(spark, lake).where(F.col("target_layer") == "bronze").select("dataset", "partition")
    return quality.bronze_audit(expected, readable, lineage, raw_counts=raw)


def verification_report(spark: SparkSession, lake: Lake, tables: Sequence[str] | None = None,
                        now: _dt.datetime | str | None = None, max_age_hours: int = 24) -> DataFrame:
    """X5 for a lake: sync summary, stale tables, per-table state and the bronze audit as one
    long DataFrame (section, table, metric, value); printing it is just ``.show()``."""
    names = list(tables) if tables is not None else [s.target_table for s in CLIENT_TABLES]
    log = synclog.read_log(spark, lake).where(F.col("table_name").isin(*names))
    states = synclog.sync_states(log)
    return quality.verification_report(
        synclog.sync_summary(log),
        synclog.stale_syncs(log, names, now=now, max_age_hours=max_age_hours),
        states.select("table_name", "last_sync_at", "rows_synced", "total_rows_synced", "sync_type"),
        audit_bronze(spark, lake, names))


def _batch_started(batch_id: str) -> _dt.datetime | None:
    """Start time encoded in a batch id (YYYYmmddTHHMMSS[ffffff]-suffix); None if not one of ours."""
    stamp = batch_id.split("-", 1)[0]
    for fmt in ("%Y%m%dT%H%M%S%f", "%Y%m%dT%H%M%S"):
        try:
            return _dt.datetime.strptime(stamp, fmt)
        except ValueError:
            continue
    return None


def superseded_at(log: DataFrame) -> DataFrame:
    """batch_id and the time from which readers no longer saw it: when the first load that supersedes it committed.

    Null for a live batch. The log of one table; a few rows per partition.
    """
    runs = log.where(F.col("status") == "ok").withColumn("_order", F.struct("last_sync_at", "run_id"))
    dated = (F.col("mode") == "partition") & F.col("partition_value").isNotNull()
    whole = F.when(F.col("mode").isin("full", "partition") & ~dated, F.col("last_sync_at"))
    same = F.when(dated, F.col("last_sync_at"))
    after = [Window.partitionBy(c).orderBy("_order").rowsBetween(1, Window.unboundedFollowing)
             for c in ("partition", "partition_value")]
    return runs.withColumn("_by_hour", F.min(whole).over(after[0])) \
        .withColumn("_by_value", F.when(dated, F.min(same).over(after[1]))) \
        .groupBy(F.col("run_id").alias("batch_id")).agg(F.min(F.least("_by_hour", "_by_value")).alias("superseded_at"))


def vacuum_bronze(spark: SparkSession, lake: Lake, table: str, retention_hours: float = 24,
                  now: _dt.datetime | None = None, uncommitted_hours: float = 24 * 7) -> list[str]:
    """Delete the batch folders of ``table`` that readers no longer see, and return them.

    Loads that the log marks as superseded go ``retention_hours`` after the load that superseded them committed,
    so a reader that listed them before has that long; folders without a log row may belong to a load that still
    runs and go only ``uncommitted_hours`` after they were begun (a load that loses its folder all the same fails
    at its commit). Metadata only: the listed folder names are anti-joined with the live batches of the log.
    """
    from lakestrata.plans.lake import _fs  # filesystem handle (driver-side metadata)
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    path = lake.path("bronze", table)
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    listed = []
    for part in fs.listStatus(root):
        if not (part.isDirectory() and part.getPath().getName().startswith("partition=")):
            continue
        for batch in fs.listStatus(part.getPath()):
            name = batch.getPath().getName()
            batch_id = name.split("=", 1)[-1]
            started = _batch_started(batch_id)
            if batch.isDirectory() and name.startswith("batch_id=") and started is not None:
                listed.append((batch_id, f"{part.getPath().getName()}/{name}", (now - started).total_seconds() / 3600))
    if not listed:
        return []
    ended = superseded_at(synclog.read_log(spark, lake, whole=True).where(F.col("table_name") == table)) \
        .withColumn("_logged", F.lit(True))
    since = (F.unix_micros(F.lit(now.isoformat()).cast("timestamp_ntz").cast("timestamp"))
             - F.unix_micros(F.col("superseded_at").cast("timestamp"))) / 3.6e9
    folders = spark.createDataFrame(listed, "batch_id string, folder string, hours double")
    unseen = folders.join(committed_batches(spark, lake, table), "batch_id", "left_anti").join(ended, "batch_id", "left") \
        .where(F.when(F.col("_logged"), since > retention_hours).otherwise(F.col("hours") > uncommitted_hours))
    dropped = sorted(r.folder for r in unseen.select("folder").collect())
    for folder in dropped:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)
    return dropped
