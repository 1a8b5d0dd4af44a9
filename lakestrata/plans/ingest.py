"""Source -> bronze ingestion: load planning, batch writes, sync-log commits.

Patterns (per :class:`~lakestrata.specs.TableSpec`):

* full refresh   -> every row (optionally filtered by ``spec.where``), replaces the partition
                    (once committed, see below);
* incremental    -> full on first run or after a reset, else ``ts > watermark`` (pushed down
                    to the source), added to the partition as a new batch;
* date partition -> ``partition_column = value`` (value required, Q28).

Exactly-once per batch (Q26 fix): each run writes its own ``batch_id`` folder, then one
sync-log row; readers keep only batches with a log row that no newer committed full load
of the partition (or newer load of the same date-partition value) supersedes
(``committed_batches``). Ingestion deletes nothing: superseded folders stay until the vacuum,
and a run whose own folder is gone fails instead of committing.
The watermark is truncated to the second by default (Q21: at-least-once at the
boundary); ``current`` scope de-duplicates by key.
"""

from __future__ import annotations

import datetime as _dt
import inspect
import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.functions.timefmt import PARTITION_PATTERN, partition_of, watermark_literal
from lakestrata.plans import synclog
from lakestrata.plans.lake import (
    Lake, append_lineage, exists, lineage_record, new_batch_id, rows_frame,
    write_partition,
)
from lakestrata.specs import Pattern, TableSpec

Reader = Callable[[TableSpec], DataFrame]


def plan_load(spec: TableSpec, source: DataFrame, state: synclog.SyncState | None = None, *,
              force_full: bool = False, partition_value: str | None = None,
              precision: str = "second", ordered: bool = False) -> tuple[DataFrame, str]:
    """(rows to load, mode) for ``spec`` given its sync state. Nothing runs here.

    ``ordered`` (O1) sorts an incremental read by its timestamp; bronze is unordered, so
    the default skips that global sort.
    """
    if force_full:
        return _full(spec, source), "full"
    if spec.pattern is Pattern.INCREMENTAL:
        if state is None or state.is_reset:
            return _full(spec, source), "full"
        df = incremental_scan(source, spec.timestamp_column, state.last_sync_value, precision)
        return (df.orderBy(spec.timestamp_column) if ordered else df), "incremental"
    if spec.pattern is Pattern.DATE_PARTITION:
        if partition_value is None:
            raise ValueError(f"{spec.target_table}: date_partition load needs partition_value")
        return date_partition_scan(source, spec.partition_column, partition_value), "partition"
    return _full(spec, source), "full"


def _full(spec: TableSpec, source: DataFrame) -> DataFrame:
    return full_scan(source, spec.where)


def full_scan(source: DataFrame, where: str | None = None) -> DataFrame:
    """Every row, optionally filtered (the predicate is pushed to the source)."""
    return source.where(F.expr(where)) if where else source


def incremental_scan(source: DataFrame, ts_column: str, last_value: _dt.datetime | None,
                     precision: str = "second") -> DataFrame:
    """Rows strictly newer than the watermark (default 1900-01-01); null ts never match (Q22).

    The literal is cast to the column's own type (folded at plan time), so the predicate
    stays ``column > literal`` and is pushed into the source scan (JDBC WHERE / Parquet).
    """
    dtype = source.schema[ts_column].dataType
    return source.where(F.col(ts_column) > watermark_literal(last_value, precision).cast(dtype))


def date_partition_scan(source: DataFrame, column: str, value: str) -> DataFrame:
    """S3: one date partition; a literal equality, so file sources prune partitions."""
    return source.where(F.col(column) == F.lit(value).cast(source.schema[column].dataType))


def read_source(reader: Reader, spec: TableSpec, watermark: _dt.datetime | None) -> DataFrame:
    """Call a reader; readers that take ``watermark`` get the run's incremental lower bound
    (e.g. to split the delta's range across parallel source queries)."""
    try:
        takes_watermark = "watermark" in inspect.signature(reader).parameters
    except (TypeError, ValueError):
        takes_watermark = False
    return reader(spec, watermark=watermark) if takes_watermark else reader(spec)


def ingest_table(spark: SparkSession, spec: TableSpec, lake: Lake, partition: str, reader: Reader, *,
                 force_full: bool = False, partition_value: str | None = None,
                 source_name: str = "source", precision: str = "second",
                 now: _dt.datetime | None = None) -> dict:
    """K1 + K7: load one table into ``bronze/{table}/partition={partition}`` and commit the run."""
    started = time.time()
    state = synclog.get_state(spark, lake, spec.target_table)
    incremental = (spec.pattern is Pattern.INCREMENTAL and not force_full
                   and state is not None and not state.is_reset)
    source = read_source(reader, spec, state.last_sync_value if incremental else None)
    df, mode = plan_load(spec, source, state, force_full=force_full,
                         partition_value=partition_value, precision=precision)
    batch_id = new_batch_id()
    path = lake.path("bronze", spec.target_table)
    if mode == "incremental":  # a delta is a sliver of every scan task: a few well-sized files instead
        df = df.hint("rebalance")
    # a new write-once batch folder; a retried job replaces only its own batch
    res = write_partition(df, path, partition, mode="overwrite", batch_id=batch_id,
                          watermark_column=spec.timestamp_column)
    duration = round(time.time() - started, 2)
    if res.rows == 0:  # Q25: nothing written, state untouched
        return {"table": spec.target_table, "rows_synced": 0, "mode": mode,
                "duration_seconds": duration, "skipped": True, "path": None}
    if not exists(spark, f"{path}/partition={partition}/batch_id={batch_id}"):
        raise RuntimeError(f"{spec.target_table}: batch {batch_id} is gone before its commit; run the load again")
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    append_lineage(spark, lake, [lineage_record(
        "bronze", path, dataset=spec.target_table, partition=partition, record_count=res.rows,
        extra={"source": source_name, "source_table": spec.full_source_name,
               "pattern": spec.pattern.value, "mode": mode, "batch_id": batch_id}, written_at=now)])
    synclog.append_log(spark, lake, {
        "table_name": spec.target_table, "run_id": batch_id, "status": "ok",
        "sync_type": spec.pattern.value, "mode": mode, "partition": partition,
        "partition_value": str(partition_value) if mode == "partition" else None,
        "last_sync_value": res.max_ts,  # null for all-null ts batches: watermark unchanged (Q22)
        "rows_synced": res.rows, "sync_duration_seconds": duration, "last_sync_at": now, "path": path})
    return {"table": spec.target_table, "rows_synced": res.rows, "mode": mode,
            "duration_seconds": duration, "skipped": False, "path": f"{path}/partition={partition}"}


def select_specs(specs: Sequence[TableSpec], tables: Sequence[str] | None = None,
                 pattern: Pattern | None = None) -> list[TableSpec]:
    chosen = [s for s in specs if (tables is None or s.target_table in tables)
              and (pattern is None or s.pattern is pattern)]
    if tables is not None:
        unknown = set(tables) - {s.target_table for s in specs}
        if unknown:
            raise KeyError(f"unknown tables: {sorted(unknown)}")
    return chosen


def ingest_all(spark: SparkSession, specs: Sequence[TableSpec], lake: Lake, partition: str,
               reader: Reader, *, tables: Sequence[str] | None = None, pattern: Pattern | None = None,
               force_full: bool = False, source_name: str = "source", max_parallel: int = 4,
               partition_value: str | None = None) -> DataFrame:
    """Ingest the selected tables; one result row per table (table, rows, mode, ..., error).

    A table that fails gets a row with mode 'error' and the reason; the others' rows stand.
    ``partition_value`` is the value that date-partition tables load.

    Tables are independent, so their jobs are submitted from up to ``max_parallel`` driver
    threads and share the cluster (small tables no longer leave it idle while they run).
    Each table writes its own folders; the shared sync-log / lineage appends take turns.
    """
    chosen = select_specs(specs, tables, pattern)

    def one(s: TableSpec) -> dict:
        try:
            return ingest_table(spark, s, lake, partition, reader, force_full=force_full, source_name=source_name,
                                partition_value=partition_value if s.pattern is Pattern.DATE_PARTITION else None)
        except Exception as e:  # noqa: BLE001 - one failing table must not hide what the others committed
            return {"table": s.target_table, "rows_synced": 0, "mode": "error", "skipped": False,
                    "error": f"{type(e).__name__}: {e}"[:2000]}

    if max_parallel <= 1 or len(chosen) <= 1:
        results = [one(s) for s in chosen]
    else:
        with ThreadPoolExecutor(max_workers=min(max_parallel, len(chosen))) as pool:
            results = list(pool.map(one, chosen))  # input order
    return rows_frame(spark, results, schemas.INGEST_RESULT)


def _live_runs(spark: SparkSession, lake: Lake, table_name: str) -> DataFrame:
    """batch_id, partition, mode, _order of the committed runs that no later load supersedes.

    A full load supersedes the partition's earlier runs, a date-partition load the earlier loads of
    its ``partition_value`` in whatever hour (logged without a value: of its partition).
    """
    return live_runs(synclog.read_log(spark, lake).where(F.col("table_name") == table_name)).drop("table_name")


def live_runs(log: DataFrame) -> DataFrame:
    """The same for every table of a log, with ``table_name``."""
    runs = log.where(F.col("status") == "ok").select(
        "table_name", F.col("run_id").alias("batch_id"), "partition", "partition_value", "mode",
        F.struct("last_sync_at", "run_id").alias("_order"))
    dated = (F.col("mode") == "partition") & F.col("partition_value").isNotNull()
    whole = runs.where(F.col("mode").isin("full", "partition") & ~dated) \
        .groupBy("table_name", "partition").agg(F.max("_order").alias("_whole"))
    same = runs.where(dated).groupBy("table_name", "partition_value").agg(F.max("_order").alias("_same"))
    return (runs.join(whole, ["table_name", "partition"], "left").join(same, ["table_name", "partition_value"], "left")
            .where(F.col("_whole").isNull() | (F.col("_order") >= F.col("_whole")))
            .where(~dated | (F.col("_order") >= F.col("_same"))))


def snapshot_sync_log(spark: SparkSession, lake: Lake, before_month: str) -> str | None:
    """Fold the closed months of the sync log, keeping what states and readers of batches need."""
    return synclog.snapshot_log(spark, lake, before_month,
                                lambda log: live_runs(log).select(F.col("batch_id").alias("run_id")))


def committed_batches(spark: SparkSession, lake: Lake, table_name: str) -> DataFrame:
    """Batch ids readers may see: committed (they have a sync-log row) and not superseded.

    Computed from the log (one row per run) with aggregates and joins; readers semi-join on
    it, which prunes ``batch_id`` folders at run time.
    """
    return _live_runs(spark, lake, table_name).select("batch_id").distinct()


def live_folders(spark: SparkSession, lake: Lake, table_name: str) -> dict[str, str]:
    """Batch id -> folder of the live batches from the table's newest full load on (all if it has none).

    What the ``current`` scope merges, so rows that the newest full load no longer has are gone. One entry per
    run since that load, from the log.
    """
    runs = _live_runs(spark, lake, table_name).withColumn("_table", F.lit(table_name))
    newest = runs.where(F.col("mode") == "full").groupBy("_table").agg(F.max("_order").alias("_newest"))
    live = runs.join(newest, "_table", "left") \
        .where(F.col("_newest").isNull() | (F.col("_order") >= F.col("_newest"))).select("batch_id", "partition").distinct()
    return {r.batch_id: f"partition={r.partition}/batch_id={r.batch_id}" for r in live.collect()}


def live_batch_count(spark: SparkSession, lake: Lake, table_name: str, partition: str) -> int:
    """Committed, not superseded batches of one partition (one number from the log)."""
    return _live_runs(spark, lake, table_name).where(F.col("partition") == partition).count()


def latest_committed_partition(spark: SparkSession, lake: Lake, table_name: str) -> str | None:
    """S12 for bronze: the newest partition that holds a committed batch (one value back).

    Taken from the sync log, not the directory listing: a run that died after writing its
    data but before its log row may have created a newer partition holding only
    uncommitted rows, which readers must skip rather than read as empty.
    """
    row = (synclog.read_log(spark, lake)
           .where((F.col("table_name") == table_name) & (F.col("status") == "ok")
                  & F.col("partition").rlike(PARTITION_PATTERN))
           .agg(F.max("partition").alias("p")).first())
    return None if row is None else row.p


def batch_watermarks(df: DataFrame, table_name: str, ts_column: str) -> DataFrame:
    """A6 + D4: rows and the new watermark (max non-null ts, truncated to the second)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.max(F.col(ts_column)).cast("timestamp_ntz").alias("max_ts")) \
        .select(F.lit(table_name).alias("table_name"), "rows",
                F.date_trunc("second", F.col("max_ts")).cast("timestamp_ntz").alias("watermark"),
                F.coalesce(F.date_format(F.col("max_ts"), "yyyy-MM-dd HH:mm:ss"), F.lit("1900-01-01"))
                .alias("watermark_sql"))


def hour_partition(ts: _dt.datetime) -> str:
    """The hour partition of a run time."""
    return ts.strftime("%Y-%m-%d-%H")


__all__ = ["plan_load", "full_scan", "incremental_scan", "date_partition_scan", "ingest_table",
           "ingest_all", "select_specs", "committed_batches", "live_folders", "latest_committed_partition", "batch_watermarks", "hour_partition",
           "partition_of"]
