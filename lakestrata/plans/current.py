"""Scope ``current`` as maintained state: every row of each key's newest batch.

The rows that are current live in a table of their own, in hash buckets by key, next to the batch each came
from. A build folds in the batches committed since the last one: it reads those batches and the buckets that
their keys fall into, and writes these buckets anew; all other buckets, and all older batches, stay unread::

    {root}/_ops/current/{table}/versions/{id}.json        what a version consists of: one rename commits it
    {root}/_ops/current/{table}/data/state_version={id}/state_bucket={n}/...

One rule at every batch count: a row is current unless a newer batch has rows of its key. What a batch itself
repeats stays, and a key with a null in it is no identity: such rows supersede nothing and are superseded only
by a full load. They go to a bucket of their own that is only ever added to, so a hot null key is never merged.

The state is built anew from the live batches when it does not fit what the log says now: a full load or a
date-partition load replaced a batch that was folded in, a load that began earlier committed later, or the
table's columns or keys changed. Versions are immutable, so readers of an older one go on until the vacuum.
"""

from __future__ import annotations

import datetime as _dt
import json
import threading
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestrata import schemas
from lakestrata.operators.latest import newest_batch_rows, whole_key
from lakestrata.plans.ingest import live_folders
from lakestrata.plans.lake import Lake, _fs, _with_partition_schema, new_batch_id
from lakestrata.specs import TableSpec

BUCKET_BYTES = 128 << 20  # input a bucket stands for; decides the number of buckets when a state is built anew
MAX_BUCKETS = 65_536
NULL_BUCKET = -1


@dataclass(frozen=True)
class Version:
    """One committed version: which batches are folded in, and the folders of every bucket."""

    id: str
    keys: list[str]
    schema: dict
    buckets: int
    batches: list[str]
    folders: dict[str, list[str]] = field(default_factory=dict)

    def paths(self, buckets=None) -> list[str]:
        wanted = self.folders if buckets is None else [str(b) for b in buckets]
        return [f for b in wanted for f in self.folders.get(str(b), [])]


def state_path(lake: Lake, table: str) -> str:
    return f"{lake.root.rstrip('/')}/_ops/current/{table}"


# ---- manifests (driver-side metadata) ------------------------------------------------------------

def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` by one rename of a finished file."""
    fs, draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, _fs(spark, path)[1]):
        raise OSError(f"could not commit {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _versions(spark: SparkSession, lake: Lake, table: str) -> list[str]:
    """Names of the committed versions, oldest first."""
    fs, p = _fs(spark, f"{state_path(lake, table)}/versions")
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def _load(spark: SparkSession, lake: Lake, table: str, name: str) -> Version:
    return Version(**json.loads(_read_text(spark, f"{state_path(lake, table)}/versions/{name}.json")))


def newest_version(spark: SparkSession, lake: Lake, table: str) -> Version | None:
    names = _versions(spark, lake, table)
    return _load(spark, lake, table, names[-1]) if names else None


# ---- folding batches in ----------------------------------------------------------------------------

def _bucket(keys, buckets: int) -> Column:
    return F.when(whole_key(keys), F.pmod(F.xxhash64(*keys), F.lit(buckets))).otherwise(NULL_BUCKET).cast("int")


def _read_batches(spark: SparkSession, lake: Lake, spec: TableSpec, folders: list[str]) -> DataFrame:
    path = lake.path("bronze", spec.target_table)
    reader = spark.read.option("basePath", path)
    schema = _with_partition_schema(schemas.BRONZE.get(spec.target_table), ["partition", "batch_id"])
    return (reader.schema(schema) if schema is not None else reader).parquet(*[f"{path}/{f}" for f in folders])


def _bucket_count(spark: SparkSession, lake: Lake, spec: TableSpec, folders: list[str]) -> int:
    path = lake.path("bronze", spec.target_table)
    size = 0
    for f in folders:
        fs, p = _fs(spark, f"{path}/{f}")
        size += int(fs.getContentSummary(p).getLength())
    return min(MAX_BUCKETS, max(1, -(-size // BUCKET_BYTES)))


def _write_buckets(spark: SparkSession, lake: Lake, table: str, version: str, rows: DataFrame, keys,
                   buckets: int) -> dict[str, list[str]]:
    """Write rows by bucket and return the folders made (from a directory listing)."""
    path = f"{state_path(lake, table)}/data/state_version={version}"
    (rows.withColumn("state_bucket", _bucket(keys, buckets)).hint("rebalance", "state_bucket")
     .write.partitionBy("state_bucket").parquet(path))
    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return {n.split("=", 1)[1]: [f"data/state_version={version}/{n}"] for n in names if n.startswith("state_bucket=")}


_LOCKS: dict[tuple[str, str], threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def fold(spark: SparkSession, lake: Lake, spec: TableSpec, buckets: int | None = None) -> Version:
    """Bring the table's state up to its live batches and return the version that holds them.

    Gold tables that are built side by side may share a source: they take turns here. Two applications
    that fold at the same time write versions of their own, each of them whole.
    """
    key = (lake.root, spec.target_table)
    with _LOCKS_GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        return _fold(spark, lake, spec, buckets)


def _fold(spark: SparkSession, lake: Lake, spec: TableSpec, buckets: int | None) -> Version:
    if not spec.keys:
        raise ValueError(f"{spec.target_table}: scope='current' needs keys")
    keys, table = list(spec.keys), spec.target_table
    live = live_folders(spark, lake, table)  # batch id -> folder, a row per run since the newest full load
    old = newest_version(spark, lake, table)
    new = sorted(set(live) - set(old.batches)) if old else sorted(live)
    same = old is not None and old.keys == keys and set(old.batches) <= set(live) and buckets in (None, old.buckets)
    if same and not new:
        return old
    delta = _read_batches(spark, lake, spec, [live[b] for b in new]) if new else None
    schema = json.loads(delta.schema.json()) if delta is not None else None
    fits = same and old.schema == schema and new[0] > max(old.batches, default="")
    version = new_batch_id()
    if fits:
        of_key = delta.where(whole_key(keys)).select(*keys).distinct()
        touched = [r.b for r in of_key.select(_bucket(keys, old.buckets).alias("b")).distinct().collect()]  # bounded
        rows = newest_batch_rows(delta, keys)
        before = old.paths(touched)
        if before:
            rows = rows.unionByName(_read_paths(spark, lake, table, old, before).join(of_key, keys, "left_anti"))
        made = _write_buckets(spark, lake, table, version, rows, keys, old.buckets)
        kept = {b: f for b, f in old.folders.items() if int(b) == NULL_BUCKET or int(b) not in set(touched)}
        folders = {b: kept.get(b, []) + made.get(b, []) for b in {*kept, *made}}
        out = Version(version, keys, old.schema, old.buckets, sorted(live), folders)
    else:
        every = sorted(live)
        delta = _read_batches(spark, lake, spec, [live[b] for b in every])
        count = buckets or _bucket_count(spark, lake, spec, [live[b] for b in every])
        rows = newest_batch_rows(delta, keys) if len(every) > 1 else delta
        folders = _write_buckets(spark, lake, table, version, rows, keys, count)
        out = Version(version, keys, json.loads(delta.schema.json()), count, every, folders)
    _write_text(spark, f"{state_path(lake, table)}/versions/{version}.json", json.dumps(asdict(out)))
    return out


def _read_paths(spark: SparkSession, lake: Lake, table: str, version: Version, folders: list[str]) -> DataFrame:
    schema = StructType.fromJson(version.schema)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{state_path(lake, table)}/{f}" for f in folders])


def current_rows(spark: SparkSession, lake: Lake, spec: TableSpec, buckets: int | None = None) -> DataFrame:
    """The current rows of a table with its folder columns ``partition`` and ``batch_id``.

    With one live batch there is nothing to supersede: the rule keeps all of it, and it is read in place.
    """
    live = live_folders(spark, lake, spec.target_table)
    if len(live) == 1:
        return _read_batches(spark, lake, spec, list(live.values()))
    version = fold(spark, lake, spec, buckets)
    return _read_paths(spark, lake, spec.target_table, version, version.paths())


def vacuum_current(spark: SparkSession, lake: Lake, table: str, retention_hours: float = 24,
                   now: _dt.datetime | None = None) -> list[str]:
    """Delete versions that were replaced more than ``retention_hours`` ago, and data no version refers to."""
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    names, base, dropped = _versions(spark, lake, table), state_path(lake, table), []
    if not names:
        return []
    fs, _ = _fs(spark, base)

    def committed(name: str) -> _dt.datetime:
        at = fs.getFileStatus(_fs(spark, f"{base}/versions/{name}.json")[1]).getModificationTime()
        return _dt.datetime.fromtimestamp(at / 1000, _dt.timezone.utc).replace(tzinfo=None)

    limit = now - _dt.timedelta(hours=retention_hours)
    stay = [n for n, after in zip(names, names[1:]) if committed(after) > limit] + names[-1:]
    for name in sorted(set(names) - set(stay)):
        fs.delete(_fs(spark, f"{base}/versions/{name}.json")[1], False)
        dropped.append(f"versions/{name}")
    used = {f for n in stay for f in _load(spark, lake, table, n).paths()}
    data = _fs(spark, f"{base}/data")[1]
    for version in (fs.listStatus(data) if fs.exists(data) else []):
        name = version.getPath().getName()
        if name.split("=", 1)[-1] > names[-1]:
            continue  # a fold that has not committed yet
        for st in fs.listStatus(version.getPath()):
            folder = f"data/{name}/{st.getPath().getName()}"
            if st.isDirectory() and folder not in used:
                fs.delete(st.getPath(), True)
                dropped.append(folder)
    return dropped
