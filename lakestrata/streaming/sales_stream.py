"""Bronze sales files -> silver -> gold, every arrived partition once.

A file-source stream over ``bronze/sales`` (explicit schema, Hive-style ``partition=`` directories) feeds
``foreachBatch``. A micro-batch only adds the partitions that have new files to a stored backlog. When the
newest file that has arrived is in it, the backlog is worked off in one go, so a partition whose files are
spread over many bounded micro-batches is rebuilt once, after its last file. For the partitions of the backlog
the stream does what the batch flow does, for all of them in the same jobs:

1. enriches the partition's current bronze rows (P6) and applies the quality gate (X1) to the whole
   partition; a partition that fails is left as it is and reported in the lineage (``rejected``);
2. replaces the silver partition (written aside, then moved in), so a retried epoch, a landing that is
   repeated and a new checkpoint all end in the same rows;
3. recomputes the gold aggregates and summary documents of these partitions;
4. appends one lineage record per written silver / gold partition, tagged with the stream (its checkpoint)
   and the epochs, and only once even when they are retried; then the backlog's epochs are removed.

The checkpoint (offsets + file log) and the backlog live in the lake's shared ``_ops`` folder, so a restarted
driver resumes and a second ``availableNow`` run reads only new files. Partitions are matched to the backlog by
a join that prunes folders at run time: no call per partition, no list of them on the driver.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata import schemas
from lakestrata.operators.sales import by_key_from_rollup, enrich_sales, sales_rollup
from lakestrata.plans.lake import Lake, _fs, append_ops, exists, read_lineage
from lakestrata.plans.sales_flow import GATED, gate_partitions
from lakestrata.plans.summary import write_summaries

MAX_FILES_PER_TRIGGER = 10_000  # files per micro-batch: bounds the partitions it touches, not what they hold


def _partitions(spark: SparkSession, path: str, wanted: DataFrame, schema) -> DataFrame:
    """The rows of some partitions of a dataset; the folders of others are pruned at run time."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    some = wanted.select("partition").where(F.col("partition") > "").distinct()
    return spark.read.schema(schema).parquet(path).join(some, "partition", "left_semi")


def _backlog(lake: Lake, stream_id: str) -> str:
    return lake.checkpoints(f"backlog-{_safe(stream_id)}")


def record(lake: Lake, stream_id: str, batch: DataFrame, epoch_id: int) -> _dt.datetime | None:
    """Add the partitions of a micro-batch to the backlog; the time its newest file arrived.

    A retried epoch replaces its own entry.
    """
    path = f"{_backlog(lake, stream_id)}/epoch={epoch_id}"
    arrived = F.col("arrived") if "arrived" in batch.columns else F.lit(None).cast("timestamp")
    batch.groupBy("partition").agg(F.max(arrived).alias("arrived")).coalesce(1).write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.parquet(path).agg(F.max("arrived").cast("double").alias("at")).first().at


def _epochs(spark: SparkSession, lake: Lake, stream_id: str) -> list[int]:
    fs, p = _fs(spark, _backlog(lake, stream_id))
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("epoch="))


def _newer_files(spark: SparkSession, lake: Lake, at: float) -> bool:
    """Is there a bronze file that arrived after ``at``? One recursive listing."""
    fs, p = _fs(spark, lake.path("bronze", "sales"))
    files = fs.listFiles(p, True)
    while files.hasNext():
        st = files.next()
        if not st.getPath().getName().startswith(("_", ".")) and st.getModificationTime() / 1000 > at + 1e-3:
            return True
    return False


def work_off(spark: SparkSession, lake: Lake, stream_id: str, report_date=None, now=None) -> list[int]:
    """Rebuild the partitions of the backlog and remove the epochs that are done. Returns these."""
    epochs = _epochs(spark, lake, stream_id)
    if not epochs:
        return []
    folders = [f"{_backlog(lake, stream_id)}/epoch={e}" for e in epochs]
    touched = spark.read.schema("partition string").parquet(*folders)
    bronze_path, silver_path = lake.path("bronze", "sales"), lake.path("silver", "sales")
    silver = enrich_sales(_partitions(spark, bronze_path, touched, schemas.with_fields(
        schemas.BRONZE["sales"], ("partition", "string"))), now)
    stats = gate_partitions(silver, lake, lake.checkpoints(f"stats-{_safe(stream_id)}"))
    current = _partitions(spark, silver_path, stats.where("good"),
                          schemas.with_fields(schemas.SILVER_SALES, ("partition", "string")))
    # the roll-up of the touched partitions (a few rows per key), written to a per-stream table
    # (each rebuild replaces it) and read back, so the three gold outputs below do not rescan silver
    rollup_path = lake.checkpoints(f"rollup-{_safe(stream_id)}")
    sales_rollup(current, ["partition"]).write.mode("overwrite").parquet(rollup_path)
    rollup = spark.read.parquet(rollup_path)
    for key in ("region", "product"):
        (by_key_from_rollup(rollup, key, report_date, by=["partition"]).hint("rebalance", "partition")
         .write.mode("overwrite").partitionBy("partition").parquet(lake.path("gold", f"sales_by_{key}")))
    write_summaries(rollup, lake, report_date, now)  # K5, for all touched partitions at once
    # retried epochs rewrote their own partitions above; their lineage is written only once
    tag = {"stream": stream_id, "epoch": str(epochs[0]) if len(epochs) == 1 else f"{epochs[0]}-{epochs[-1]}"}
    done = read_lineage(spark, lake).where(
        (F.col("extra")["stream"] == stream_id) & (F.col("extra")["epoch"] == tag["epoch"]))
    if done.isEmpty():
        append_ops(_lineage(stats, lake, tag, _naive(now)), lake.lineage, "written_at")
    for folder in folders:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)
    return epochs


def _process(lake: Lake, report_date, now, stream_id: str, batch: DataFrame, epoch_id: int) -> None:
    """One micro-batch: into the backlog, which is worked off unless files have arrived that are still to come."""
    at = record(lake, stream_id, batch, epoch_id)
    if at is None or not _newer_files(batch.sparkSession, lake, at):
        work_off(batch.sparkSession, lake, stream_id, report_date, now)


def _lineage(stats: DataFrame, lake: Lake, tag: dict, now: _dt.datetime | None) -> DataFrame:
    """Lineage of an epoch, made from its per-partition statistics: the silver partition, the three gold
    outputs, or one ``rejected`` record with the minima."""
    at = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    text = F.lit(None).cast("string")
    silver_path = lake.path("silver", "sales")

    def record(layer: str, path: str, dataset: str, source: str, source_path: str, count: Column,
               **extra: Column | str) -> Column:
        entries = [c for k, v in {**tag, **extra}.items() for c in (F.lit(k), v if isinstance(v, Column) else F.lit(v))]
        return F.struct(
            F.lit(layer).alias("target_layer"), F.lit(path).alias("target_path"), F.lit(dataset).alias("dataset"),
            F.col("partition"), F.lit(source).alias("source_layer"), F.lit(source_path).alias("source_path"),
            count.cast("bigint").alias("record_count"),
            (F.array(F.lit("sales")) if layer == "gold" else F.lit(None)).cast("array<string>").alias("source_tables"),
            F.create_map(*entries).alias("extra"), F.lit(at.isoformat()).cast("timestamp_ntz").alias("written_at"))

    gold = [record("gold", lake.path("gold", name), name, "silver", silver_path, count, **extra) for name, count, extra in (
        ("sales_by_region", text, {"aggregation": "by_region"}), ("sales_by_product", text, {"aggregation": "by_product"}),
        ("daily_summary", F.lit(1), {}))]
    kept = F.array(record("silver", silver_path, "sales", "bronze", lake.path("bronze", "sales"), F.col("rows"),
                          transformations="calculate_total_amount,add_processed_at"), *gold)
    minima = F.concat_ws(",", *[F.concat(F.lit(f"min_{c}="), F.coalesce(F.col(f"min_{c}").cast("string"), F.lit("null")))
                                for c in GATED])
    rejected = F.array(record("rejected", silver_path, "sales", "bronze", lake.path("bronze", "sales"), F.col("rows"),
                              reason=minima))
    return stats.where("good").select(F.inline(kept)).unionByName(stats.where(~F.col("good")).select(F.inline(rejected)))


def _safe(name: str) -> str:
    """A folder-name-safe tag of a stream id (its checkpoint location)."""
    return hashlib.sha1(name.encode()).hexdigest()[:12]


def _naive(now) -> _dt.datetime | None:
    """The run's fixed clock as a naive UTC datetime; None (wall clock) otherwise."""
    if isinstance(now, _dt.datetime):
        return now
    if isinstance(now, str):
        return _dt.datetime.fromisoformat(now)
    return None


def start_sales_stream(spark: SparkSession, lake: Lake, *, report_date=None, now=None,
                       available_now: bool = True, processing_time: str | None = None,
                       max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                       checkpoint: str | None = None) -> StreamingQuery:
    """Start W1. ``max_files_per_trigger`` bounds each micro-batch (a backlog is drained in
    several bounded batches, also under ``availableNow``); None reads all arrived files at once."""
    source_schema = schemas.with_fields(schemas.BRONZE["sales"], ("partition", "string"))
    reader = spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(lake.path("bronze", "sales")) \
        .select("partition", F.col("_metadata.file_modification_time").alias("arrived"))
    checkpoint = checkpoint or lake.checkpoints("sales_stream")
    writer = (stream.writeStream
              .foreachBatch(lambda df, eid: _process(lake, report_date, now, checkpoint, df, eid))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def run_available_now(spark: SparkSession, lake: Lake, **kwargs) -> None:
    """Process every file that has arrived, then stop (the scheduled, arrival-driven run).

    What is left in the backlog then (files arrived meanwhile, or an earlier run broke off) is worked off, too.
    """
    q = start_sales_stream(spark, lake, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    checkpoint = kwargs.get("checkpoint") or lake.checkpoints("sales_stream")
    work_off(spark, lake, checkpoint, kwargs.get("report_date"), kwargs.get("now"))
