"""SparkSession construction and the session settings every plan relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine's semantics depend on (set at runtime on any session we are handed).
RUNTIME_CONF = {
    # All wall-clock maths in UTC; in-flight timestamps are TIMESTAMP_NTZ anyway.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # demote sort-merge joins to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    # What a task sorts is some five times its compressed bytes: 32 MB are sorted in memory on a small executor.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # Broadcast what a finished stage has measured below 32 MB; everything else sort-merges. Before a stage has
    # run the planner only knows the bytes of compressed files, which are 20 to 60 times as many in the driver's
    # hash table, and it does not go back on a broadcast planned by them: so only tiny files count as small.
    "spark.sql.autoBroadcastJoinThreshold": "256KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Overwrite only the partitions a write touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values such as 2025-01-15-14 must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "lakestrata",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.

    On a cluster leave ``master`` unset and let spark-submit decide; tests pass ``local[*]``.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # reliable checkpoints (rollups, compaction snapshots) are deleted once unused,
               # so scheduled runs do not pile files up in the shared checkpoint folder
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session (what the cluster names as its shared
    folder). Only when it is unset (local tests) is a private scratch folder created.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = local_scratch(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    path = base.rstrip("/") + "/" + name
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def local_scratch(master: str) -> str:
    """A private scratch folder, only for a local session (tests, single-machine runs).

    On a cluster every executor must see the folder, so the cluster has to name a shared
    one in ``spark.checkpoint.dir``; a machine-local folder is never used there.
    """
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: name a shared folder for this cluster session")
    return tempfile.mkdtemp(prefix="lakestrata-")


def sizing(input_bytes: int, cores: int, max_tasks: int = 100_000) -> dict[str, str]:
    """Scan / shuffle sizing for a job reading ``input_bytes`` on ``cores`` executor cores.

    Map-output metadata grows with (map tasks x reduce partitions), so both are capped at
    ``max_tasks``: scan splits grow beyond 128 MB once the input would need more tasks, and
    shuffle partitions target ~256 MB of input each (at least 2x the cores). AQE then
    coalesces small reducers to the advisory size (not to the core count) and splits
    skewed ones at run time.
    Example: 100 TB on 1000 executors x 8 cores -> ~1.1 GB splits, 100k shuffle partitions.
    """
    mb = 1 << 20
    split = max(128 * mb, -(-input_bytes // max_tasks))
    partitions = min(max_tasks, max(2 * cores, -(-input_bytes // (256 * mb))))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        # on a shared cluster coalesce to the advisory size (fewer, well-sized reducers and
        # output files) instead of maximising the number of small post-shuffle partitions
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
