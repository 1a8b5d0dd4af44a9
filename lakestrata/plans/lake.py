"""Lake layout, partitioned writers with lineage, and layered readers.

Layout (all Parquet, one directory per dataset, Hive-style ``partition=YYYY-MM-DD-HH``)::

    {root}/bronze/{table}/partition=.../batch_id=...   (one write-once folder per run)
    {root}/silver/{dataset}/partition=...
    {root}/gold/{dataset}/partition=...
    {root}/_ops/sync_log      append-only ingestion log
    {root}/_ops/lineage       append-only lineage records

Writes overwrite only the partitions they touch (dynamic partition overwrite: a failed
job leaves the previous partition in place; lost executors just re-run tasks). Bronze
runs never replace or delete committed files: each run writes its own ``batch_id`` folder, and
folders that a later load supersedes stay until the vacuum. Row
counts and watermarks come from an ``Observation`` of the write itself, not a 2nd scan.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, MapType, StructType, TimestampNTZType,
)

from lakestrata import schemas
from lakestrata.functions.timefmt import PARTITION_PATTERN

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Lake:
    """A lake rooted at a shared filesystem URI (``hdfs://``, ``s3a://``, ``abfss://``, ``file:``)."""

    root: str

    def path(self, layer: str, dataset: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"

    @property
    def sync_log(self) -> str:
        return f"{self.root.rstrip('/')}/_ops/sync_log"

    @property
    def sync_state(self) -> str:
        return f"{self.root.rstrip('/')}/_ops/sync_state"

    @property
    def lineage(self) -> str:
        return f"{self.root.rstrip('/')}/_ops/lineage"

    def checkpoints(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_ops/checkpoints/{name}"


def new_batch_id() -> str:
    """A run id that sorts by start time (microseconds), with a random suffix against clashes."""
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


# ---- filesystem helpers (driver-side metadata only: directory names, never data) -------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def lake_bytes(spark: SparkSession, lake: Lake) -> int:
    """Bytes that the lake holds, from the filesystem's summary (metadata only)."""
    fs, p = _fs(spark, lake.root)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_partition_values(spark: SparkSession, path: str, column: str = "partition") -> list[str]:
    """Values of the top-level ``column=value`` directories under ``path`` (unsorted)."""
    import re
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    prefix = column + "="
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            value = name[len(prefix):]
            if re.fullmatch(PARTITION_PATTERN[1:-1], value):
                out.append(value)
    return out


def latest_partition_value(spark: SparkSession, path: str) -> str | None:
    """Newest valid partition of a dataset, from a directory listing."""
    values = list_partition_values(spark, path)
    return max(values) if values else None


def list_partitions(spark: SparkSession, path: str, limit: int = 10) -> list[str]:
    """Newest-first partition names (metadata only)."""
    return sorted(set(list_partition_values(spark, path)), reverse=True)[:limit]


# ---- writers -------------------------------------------------------------------------

@dataclass
class WriteResult:
    path: str
    partition: str | None
    rows: int
    max_ts: _dt.datetime | None = None


def write_partition(df: DataFrame, path: str, partition: str | Column | None, *, mode: str = "overwrite",
                    batch_id: str | None = None, watermark_column: str | None = None,
                    fmt: str = "parquet") -> WriteResult:
    """K1/K3/K4: write ``df`` as partition ``partition`` of the dataset at ``path``.

    ``partition`` is one value, or a Column giving each row's partition (several at once).

    ``mode='overwrite'`` replaces only that partition (dynamic overwrite); ``'append'``
    adds files. With ``batch_id`` the rows go to their own ``partition=P/batch_id=B``
    folder: other batches of the partition are never touched, and a retried job of the
    same batch replaces its own output instead of duplicating it.
    """
    out = df
    part_cols = []
    if partition is not None:
        out = out.withColumn("partition", partition if isinstance(partition, Column) else F.lit(partition))
        part_cols.append("partition")
    if batch_id is not None:
        out = out.withColumn("batch_id", F.lit(batch_id))
        part_cols.append("batch_id")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if watermark_column:
        metrics.append(F.max(F.col(watermark_column)).alias("max_ts"))
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    out = out.observe(obs, *metrics)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    elif fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if part_cols:
        writer = writer.partitionBy(*part_cols)
    writer.save(path)
    got = obs.get
    return WriteResult(path, None if isinstance(partition, Column) else partition,
                       int(got.get("rows", 0) or 0), got.get("max_ts"))


def lineage_record(target_layer: str, target_path: str, *, dataset: str | None = None,
                   partition: str | None = None, source_layer: str | None = None,
                   source_path: str | None = None, record_count: int | None = None,
                   source_tables: Sequence[str] | None = None, extra: dict | None = None,
                   written_at: _dt.datetime | None = None) -> dict:
    return {
        "target_layer": target_layer, "target_path": target_path, "dataset": dataset,
        "partition": partition, "source_layer": source_layer, "source_path": source_path,
        "record_count": record_count, "source_tables": list(source_tables) if source_tables else None,
        "extra": {k: str(v) for k, v in (extra or {}).items()} or None,
        "written_at": written_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
    }


def literal(value, dtype: DataType) -> Column:
    """One typed literal. Naive datetimes go through text, so no time zone can shift them."""
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, MapType):
        return F.create_map(*[c for k, v in value.items()
                              for c in (literal(k, dtype.keyType), literal(v, dtype.valueType))]).cast(dtype)
    if isinstance(dtype, ArrayType):
        return F.array(*[literal(v, dtype.elementType) for v in value]).cast(dtype)
    if isinstance(dtype, (TimestampNTZType, DateType)) and isinstance(value, (_dt.datetime, _dt.date)):
        return F.lit(value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def rows_frame(spark: SparkSession, rows: Sequence[dict], schema: StructType) -> DataFrame:
    """A handful of metadata rows (run results, log and lineage records) as a literal plan.

    Built from JVM literals (``inline`` of an array of structs over a one-row range), so no
    Python worker or pickled RDD is involved; meant for a few rows per job, never for data.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[literal(r.get(f.name), f.dataType).alias(f.name) for f in schema.fields])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


OPS_PARTITION = "log_month"  # ops tables (sync log, lineage) are partitioned by month


def _move_in(spark: SparkSession, staging: str, folder: str) -> None:
    """Move the data files of ``staging`` into ``folder`` under names of their own (a rename per file)."""
    fs, src = _fs(spark, staging)
    _, dst = _fs(spark, folder)
    fs.mkdirs(dst)
    for st in fs.listStatus(src):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst, f"part-{uuid.uuid4().hex}.parquet")
            if not fs.rename(st.getPath(), target):
                raise OSError(f"could not move {st.getPath()} into {folder}")


def append_ops(df: DataFrame, path: str, ts_column: str, least_month: str | None = None, few: bool = False) -> None:
    """Append metadata rows to a month-partitioned ops table: any number, dealt by month into files of
    bounded size, or with ``few`` a handful of rows that one task writes.

    Every append writes a folder of its own and then moves its files in, so jobs of this or any
    other application that append at the same time share no temporary folder. Rows of months before
    ``least_month`` are filed under it (months that a snapshot stands for are not read again).
    """
    spark = df.sparkSession
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    month = F.date_format(F.col(ts_column), "yyyy-MM")
    month = F.greatest(month, F.lit(least_month)) if least_month else month
    out = df.withColumn(OPS_PARTITION, month)
    (out.coalesce(1) if few else out.hint("rebalance", OPS_PARTITION)).write.partitionBy(OPS_PARTITION).parquet(staging)
    fs, p = _fs(spark, staging)
    for st in fs.listStatus(p):
        if st.isDirectory() and st.getPath().getName().startswith(OPS_PARTITION + "="):
            _move_in(spark, st.getPath().toString(), f"{path}/{st.getPath().getName()}")
    fs.delete(p, True)


def ops_months(spark: SparkSession, path: str) -> list[str]:
    """Months that an ops table has folders for, oldest first."""
    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(OPS_PARTITION + "="))


def read_ops(spark: SparkSession, path: str, schema: StructType, after: str | None = None) -> DataFrame:
    """An ops table, or only its months later than ``after``: no folder of another month is opened."""
    months = [m for m in ops_months(spark, path) if after is None or m > after]
    if not months:
        return spark.createDataFrame([], schemas.with_fields(schema, (OPS_PARTITION, "string")))
    return spark.read.schema(schemas.with_fields(schema, (OPS_PARTITION, "string"))).option("basePath", path) \
        .parquet(*[f"{path}/{OPS_PARTITION}={m}" for m in months])


def compact_partition(spark: SparkSession, path: str, value: str, column: str = OPS_PARTITION,
                      files: int = 1) -> None:
    """Rewrite the files that one partition of an append-only table has now into ``files`` files.

    Exactly the listed files are read, replaced and deleted: what other jobs append meanwhile stays.
    A crash between the two steps leaves rows twice, never none; readers drop repeats.
    """
    folder = f"{path}/{column}={value}"
    fs, p = _fs(spark, folder)
    listed = [st.getPath() for st in fs.listStatus(p)
              if st.isFile() and not st.getPath().getName().startswith(("_", "."))]
    if len(listed) <= files:
        return
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    spark.read.parquet(*[f.toString() for f in listed]).coalesce(files).write.parquet(staging)
    _move_in(spark, staging, folder)
    for f in listed:
        fs.delete(f, False)
    fs.delete(_fs(spark, staging)[1], True)


def compact_ops(spark: SparkSession, lake: Lake, before_month: str) -> list[str]:
    """Compact every month partition of the sync log and lineage older than ``before_month``."""
    done = []
    for path in (lake.sync_log, lake.lineage):
        fs, p = _fs(spark, path)
        if not fs.exists(p):
            continue
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(OPS_PARTITION + "="):
                month = name.split("=", 1)[1]
                if month < before_month:
                    compact_partition(spark, path, month)
                    done.append(f"{path}/{name}")
    return done


def append_lineage(spark: SparkSession, lake: Lake, records: Iterable[dict]) -> None:
    """K6: append lineage records (a few metadata rows per job) to the lineage table."""
    rows = list(records)
    if rows:
        append_ops(rows_frame(spark, rows, schemas.LINEAGE), lake.lineage, "written_at", few=True)


def read_lineage(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every lineage record once (an interrupted compaction may leave a record in two files)."""
    rows = read_ops(spark, lake.lineage, schemas.LINEAGE).withColumn("_extra", F.array_sort(F.map_entries("extra")))
    return rows.dropDuplicates([c for c in rows.columns if c != "extra"]).drop("_extra")


def write_gold(df: DataFrame, lake: Lake, name: str, partition: str, sources: Sequence[str],
               source_layer: str = "bronze", extra: dict | None = None) -> WriteResult:
    """K4: gold partition overwrite + lineage row (record count from the write itself)."""
    path = lake.path("gold", name)
    res = write_partition(df, path, partition)
    if not res.rows:  # a dynamic overwrite with no rows touches nothing: the old rows must go, the schema stay
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/partition={partition}")
    append_lineage(df.sparkSession, lake, [lineage_record(
        "gold", path, dataset=name, partition=partition, source_layer=source_layer,
        source_path=",".join(lake.path(source_layer, s) for s in sources),
        record_count=res.rows, source_tables=sources, extra=extra)])
    return res


# ---- readers -------------------------------------------------------------------------

def _with_partition_schema(schema: StructType | None, extra: Sequence[str]) -> StructType | None:
    if schema is None:
        return None
    out = StructType(list(schema.fields))
    for name in extra:
        if name not in out.fieldNames():
            out = out.add(name, "string")
    return out


def read_layer(spark: SparkSession, lake: Lake, layer: str, dataset: str,
               schema: StructType | None = None, scope: str = "all", *,
               partition: str | None = None, keys: Sequence[str] = (),
               order_by: Sequence[str] = (), committed_batches: DataFrame | None = None) -> DataFrame:
    """Read a layered dataset.

    ``scope``: ``all`` (every partition, U1/Q30), ``latest`` (newest partition, pruned at
    plan time from a directory listing, S12/Q29), ``partition`` (the one given), or
    ``current`` (over all partitions: every row of each key's newest batch, or where the layer has no
    batches the latest version of every key, Q29 fix).
    ``committed_batches`` (a DataFrame of ``batch_id``) keeps only batches the sync log
    has committed (Q26 fix): a left-semi join against a small log-derived table.
    """
    path = lake.path(layer, dataset)
    reader = spark.read
    full_schema = _with_partition_schema(schema, ["partition"] + (["batch_id"] if layer == "bronze" else []))
    if full_schema is not None:
        reader = reader.schema(full_schema)
    value = partition
    if scope == "latest":
        value = latest_partition_value(spark, path)
    if scope in ("latest", "partition") and value is None:
        raise ValueError(f"no partitions found for {layer}/{dataset}")
    one = f"{path}/partition={value}"
    if scope in ("latest", "partition") and exists(spark, one):  # list that partition only
        df = reader.option("basePath", path).parquet(one)
    else:
        df = reader.parquet(path)
    if committed_batches is not None and "batch_id" in df.columns:
        df = df.join(committed_batches.select("batch_id").distinct(), "batch_id", "left_semi")
    if scope == "all":
        return df
    if scope in ("latest", "partition"):
        return df.where(F.col("partition") == F.lit(value))
    if scope == "current":
        from lakestrata.operators.latest import current_by_key, newest_batch_rows
        if not keys:
            raise ValueError("scope='current' needs keys")
        if "batch_id" in df.columns:
            return newest_batch_rows(df, keys)
        return current_by_key(df, keys, list(order_by) + ["partition"])
    raise ValueError(f"unknown scope {scope!r}")


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Reference-style bronze files (one JSON array of row objects per file).

    A JSON array document is not splittable (one task per file), so this is for
    compatibility reads; the engine's own bronze layout is Parquet.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv_layer(spark: SparkSession, glob_path: str, schema: StructType,
                   partition_regex: str = r"/(\d{4}-\d{2}-\d{2}-\d{2})/") -> DataFrame:
    """Typed CSV over a wildcard of partition directories, header row skipped.

    The partition value is recovered from each row's file path (``_metadata``).
    Empty fields are '' and missing fields null (Q34).
    """
    df = (spark.read.schema(schema).option("header", True).option("emptyValue", "")
          .option("nullValue", "\u0000").csv(glob_path))
    return df.withColumn("partition", F.regexp_extract(F.col("_metadata.file_path"), partition_regex, 1))
