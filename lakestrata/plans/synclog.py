"""Append-only ingestion log: state, watermarks, totals, freshness.

One row per finished run replaces the reference's mutable per-table state document.
Readers derive the state with aggregates, so writers never read-modify-write:

* latest row per table            -> ``max_by(row, (last_sync_at, run_id))``
* watermark                       -> newest non-null ``last_sync_value`` since the last reset
* ``total_rows_synced``           -> sum of ``rows_synced`` since the last reset (Q24)
* ``status='reset'`` as latest row -> next load is a full load (Q23 fix)

Log-derived frames have one row per table (or per run), tiny next to the data. Closed months are folded into a
snapshot (:func:`snapshot_log`) of a few rows per table and one per live batch, so a reader opens the snapshot
and the months after it, however long the log is.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.functions.timefmt import hours_between
from lakestrata.plans.lake import OPS_PARTITION, Lake, _fs, append_ops, ops_months, read_ops, rows_frame

REGISTERED = schemas._struct(("table_name", schemas.S))


@dataclass(frozen=True)
class SyncState:
    table_name: str
    status: str
    last_sync_value: _dt.datetime | None
    last_sync_at: _dt.datetime | None
    rows_synced: int
    total_rows_synced: int
    previous_sync_at: _dt.datetime | None = None
    previous_sync_value: _dt.datetime | None = None

    @property
    def is_reset(self) -> bool:
        return self.status == "reset"


def _opt(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def normalized(log: DataFrame) -> DataFrame:
    """Fill optional log columns so fixture-shaped and engine-written logs look alike."""
    return log.select(
        F.col("table_name"),
        F.col("run_id").cast("string").alias("run_id"),
        _opt(log, "status", F.lit("ok")).alias("status"),
        _opt(log, "sync_type", F.lit(None).cast("string")).alias("sync_type"),
        F.col("last_sync_at").cast("timestamp_ntz").alias("last_sync_at"),
        _opt(log, "last_sync_value", F.lit(None).cast("timestamp_ntz")).cast("timestamp_ntz").alias("last_sync_value"),
        F.coalesce(_opt(log, "rows_synced", F.lit(0)), F.lit(0)).cast("bigint").alias("rows_synced"),
        _order().alias("_order"),
    )


def _order() -> Column:
    """Order of runs: time, then run ids, which compare as numbers when they are (fixtures), else as text."""
    return F.struct(F.col("last_sync_at").cast("timestamp_ntz").alias("last_sync_at"),
                    F.col("run_id").try_cast("bigint").alias("number"), F.col("run_id").cast("string").alias("run_id"))


def _snapshots(spark: SparkSession, lake: Lake) -> list[str]:
    """Months that a stored snapshot of the log ends with, oldest first."""
    fs, p = _fs(spark, lake.sync_state)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("as_of="))


def read_log(spark: SparkSession, lake: Lake, whole: bool = False) -> DataFrame:
    """Every run once (an interrupted compaction may leave a row in two files).

    Reads the newest snapshot and the months after it, which give every state that the whole log gives.
    ``whole`` reads all runs ever logged instead.
    """
    taken = [] if whole else _snapshots(spark, lake)
    if not taken:
        return read_ops(spark, lake.sync_log, schemas.SYNC_LOG).drop(OPS_PARTITION).distinct()
    later = read_ops(spark, lake.sync_log, schemas.SYNC_LOG, after=taken[-1]).drop(OPS_PARTITION)
    folded = spark.read.schema(schemas.SYNC_LOG).parquet(f"{lake.sync_state}/as_of={taken[-1]}")
    return folded.unionByName(later).distinct()


def folded_log(log: DataFrame, live: DataFrame) -> DataFrame:
    """The few rows of a log from which states and live batches follow as from all of it.

    Per table: its newest run, the run before, the newest reset, the run that gave the watermark, the newest
    partition, and the ``live`` runs (run_id) that no later load supersedes. The rows synced by all other runs
    since the reset are carried in one row of status ``carried``. Folding a folded log changes nothing.
    """
    n = log.withColumn("_order", _order()).withColumn("_n", F.coalesce(F.col("rows_synced"), F.lit(0)))
    marks = n.groupBy("table_name").agg(
        F.max(F.when(F.col("status") == "reset", F.col("_order"))).alias("_reset"), F.max("_order").alias("_latest"),
        F.max_by("_order", F.when(F.col("status") == "ok", F.struct("partition", "_order"))).alias("_newest_part"))
    n = n.join(F.broadcast(marks), "table_name")  # a row per table
    since = F.col("_reset").isNull() | (F.col("_order") > F.col("_reset"))
    real = F.col("status") != "carried"
    more = n.groupBy("table_name").agg(
        F.max(F.when(real & (F.col("_order") < F.col("_latest")), F.col("_order"))).alias("_before"),
        F.max(F.when(since & F.col("last_sync_value").isNotNull(), F.col("_order"))).alias("_mark"))
    # live runs grow with the log: they are merged by run, never sent whole to the driver and to every task
    runs = live.select("run_id", F.lit(True).alias("_live")).distinct().hint("merge")
    n = n.join(F.broadcast(more), "table_name").join(runs, "run_id", "left")
    stays = real & (F.col("_live").isNotNull() | reduce(lambda a, b: a | b, [F.coalesce(F.col("_order") == F.col(c), F.lit(False))
                                                        for c in ("_latest", "_before", "_reset", "_mark", "_newest_part")]))
    columns = schemas.SYNC_LOG.fieldNames()
    at = F.max("_order").alias("_at")
    carried = n.where(~stays & since).groupBy("table_name").agg(F.sum("_n").alias("rows_synced"), at) \
        .select("table_name", F.col("_at.run_id").alias("run_id"), F.lit("carried").alias("status"), "rows_synced",
                F.col("_at.last_sync_at").alias("last_sync_at"))
    carried = carried.select(*[(F.col(f.name) if f.name in carried.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in schemas.SYNC_LOG.fields])
    return n.where(stays).select(*columns).unionByName(carried)


def snapshot_log(spark: SparkSession, lake: Lake, before_month: str,
                 live: Callable[[DataFrame], DataFrame]) -> str | None:
    """Fold the closed months before ``before_month`` into a snapshot; readers then open it and later months only.

    Built from the last snapshot and the months since; ``live`` gives the run ids of a log that readers may see.
    The runs, each once, are stored for the time of the fold, which reads them several times. Returns the month
    the snapshot ends with, None if no month is new. The log itself stays whole.
    """
    taken = _snapshots(spark, lake)
    months = [m for m in ops_months(spark, lake.sync_log) if m < before_month and (not taken or m > taken[-1])]
    if not months:
        return None
    staging = f"{lake.sync_state}/_staging-{uuid.uuid4().hex}"
    fs, source = _fs(spark, f"{staging}/folded")
    read_log(spark, lake).write.parquet(f"{staging}/runs")
    runs = spark.read.schema(schemas.SYNC_LOG).parquet(f"{staging}/runs")
    closed = runs.where(F.date_format("last_sync_at", "yyyy-MM") < before_month)
    folded_log(closed, live(runs)).hint("rebalance").write.parquet(f"{staging}/folded")
    if not fs.rename(source, _fs(spark, f"{lake.sync_state}/as_of={months[-1]}")[1]):
        raise OSError(f"could not commit the snapshot of {months[-1]}")
    fs.delete(_fs(spark, staging)[1], True)
    return months[-1]


def _month_after(month: str) -> str:
    year, number = map(int, month.split("-"))
    return f"{year + number // 12:04}-{number % 12 + 1:02}"


def append_log(spark: SparkSession, lake: Lake, row: dict) -> None:
    """K7/K8: the commit point of a run: one row appended after the data is written."""
    full = {f.name: row.get(f.name) for f in schemas.SYNC_LOG.fields}
    taken = _snapshots(spark, lake)
    append_ops(rows_frame(spark, [full], schemas.SYNC_LOG), lake.sync_log, "last_sync_at",
               _month_after(taken[-1]) if taken else None, few=True)


def sync_states(log: DataFrame) -> DataFrame:
    """K9: per table the latest run, the effective watermark and totals since the last reset.

    Two aggregates with map-side partials and no window: per-table markers (newest reset,
    newest run; one row per table) are joined back to the runs, then one aggregate per
    table. A table holding most of the runs is never gathered into one task: each task
    folds its own rows before the shuffle, and the marker join is one row per table.
    """
    n = normalized(log)
    markers = n.groupBy("table_name").agg(
        F.max(F.when(F.col("status") == "reset", F.col("_order"))).alias("_reset_order"),
        F.max("_order").alias("_latest_order"))
    n = n.join(markers, "table_name")
    since_reset = F.col("_reset_order").isNull() | (F.col("_order") > F.col("_reset_order"))
    row_cols = [c for c in n.columns if c not in ("table_name", "_reset_order", "_latest_order")]
    agg = n.groupBy("table_name").agg(
        F.max_by(F.struct(*row_cols), F.col("_order")).alias("r"),
        F.sum(F.when(since_reset, F.col("rows_synced"))).alias("total_rows_synced"),
        F.max_by(F.col("last_sync_value"),
                 F.when(since_reset & F.col("last_sync_value").isNotNull(), F.col("_order"))).alias("watermark"),
        F.max_by(F.struct("last_sync_at", "last_sync_value", "status"),
                 F.when(F.col("_order") < F.col("_latest_order"), F.col("_order"))).alias("p"),
    )
    is_reset = F.col("r.status") == "reset"
    return agg.select(
        "table_name", F.col("r.run_id").alias("run_id"), F.col("r.status").alias("status"),
        F.col("r.sync_type").alias("sync_type"),
        # a reset marker is not a sync: no last sync until the next run (reported as reset_at)
        F.when(~is_reset, F.col("r.last_sync_at")).alias("last_sync_at"),
        F.col("r.rows_synced").alias("rows_synced"),
        F.when(is_reset, F.lit(None)).otherwise(F.col("watermark")).cast("timestamp_ntz").alias("last_sync_value"),
        F.when(is_reset, F.lit(0)).otherwise(F.coalesce(F.col("total_rows_synced"), F.lit(0)))
        .cast("bigint").alias("total_rows_synced"),
        # the run before; a reset marker carries no previous sync (the next run starts over)
        F.when(F.col("p.status") != "reset", F.col("p.last_sync_at")).alias("previous_sync_at"),
        F.when(F.col("p.status") != "reset", F.col("p.last_sync_value")).alias("previous_sync_value"),
        F.when(is_reset, F.col("r.last_sync_at")).alias("reset_at"))


def sync_latest(log: DataFrame) -> DataFrame:
    """K9 (plain form): the latest log row of every table; ties broken by run id."""
    cols = [c for c in log.columns if c != "table_name"]
    order = F.struct(F.col("last_sync_at").cast("timestamp_ntz"), F.col("run_id").try_cast("bigint"),
                     F.col("run_id").cast("string"))
    return (log.groupBy("table_name").agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("r"))
            .select("table_name", "r.*"))


def get_state(spark: SparkSession, lake: Lake, table_name: str) -> SyncState | None:
    """K9: the state of one table (one small row to the driver), None if never synced."""
    row = sync_states(read_log(spark, lake).where(F.col("table_name") == table_name)).first()
    if row is None:
        return None
    return SyncState(row.table_name, row.status, row.last_sync_value, row.last_sync_at,
                     int(row.rows_synced or 0), int(row.total_rows_synced or 0),
                     row.previous_sync_at, row.previous_sync_value)


def get_last_sync_value(spark: SparkSession, lake: Lake, table_name: str) -> _dt.datetime | None:
    state = get_state(spark, lake, table_name)
    return None if state is None or state.is_reset else state.last_sync_value


def reset_sync_state(spark: SparkSession, lake: Lake, table_name: str,
                     now: _dt.datetime | None = None) -> bool:
    """K8: append a reset marker; the next load of the table is a full load. False if never synced."""
    if get_state(spark, lake, table_name) is None:
        return False
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    append_log(spark, lake, {"table_name": table_name, "run_id": "reset-" + now.strftime("%Y%m%dT%H%M%S%f"),
                             "status": "reset", "last_sync_at": now, "rows_synced": 0})
    return True


def sync_summary(log: DataFrame) -> DataFrame:
    """Tables tracked, rows synced since the last reset, oldest / newest sync."""
    states = sync_states(log)
    return states.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_tables"),
        F.coalesce(F.sum("total_rows_synced"), F.lit(0)).cast("bigint").alias("total_rows_synced"),
        F.min("last_sync_at").alias("oldest_sync"),
        F.max("last_sync_at").alias("newest_sync"))


def stale_syncs(log: DataFrame, registered: Sequence[str] | DataFrame | None = None,
                now: _dt.datetime | str | None = None, max_age_hours: int = 24) -> DataFrame:
    """Tables never synced or whose last sync is older than ``max_age_hours``.

    ``registered`` (table names from the spec registry) adds tables with no log row at all.
    """
    now_col = F.current_timestamp().cast("timestamp_ntz") if now is None else F.lit(str(now)).cast("timestamp_ntz")
    states = sync_states(log).select("table_name", "last_sync_at")
    spark = log.sparkSession
    if registered is not None:
        reg = registered if isinstance(registered, DataFrame) else \
            rows_frame(spark, [{"table_name": t} for t in registered], REGISTERED)
        states = reg.select("table_name").distinct().join(states, "table_name", "full")
    cutoff = now_col - F.expr(f"INTERVAL {int(max_age_hours)} HOURS")
    never = F.col("last_sync_at").isNull()
    stale = states.where(never | (F.col("last_sync_at") < cutoff))
    return stale.select(
        F.col("table_name").alias("table"),
        F.col("last_sync_at").alias("last_sync"),
        F.when(~never, hours_between(F.col("last_sync_at"), now_col)).alias("hours_ago"),
        F.when(never, F.lit("Never synced"))
        .otherwise(F.lit(f"Sync older than {int(max_age_hours)}h")).alias("reason"))
