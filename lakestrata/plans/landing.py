"""Writes that stay out of sight until they are accepted.

Rows go to an uncommitted folder first. What was written is then known from the written files: the row count
and the minima of the gated columns come from the write itself (one partition) or are read back per partition
from the files, where counts need only the footers and minima only the gated columns. The input is evaluated
once. Accepted partitions are moved in by renames; a partition that is not accepted leaves its old rows alone::

    {root}/_ops/staging/{dataset}-{id}/partition=P/...        until it is moved or discarded
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.quality import quality_minima
from lakestrata.plans.lake import Lake, _fs

MOVES_AT_ONCE = 16


@dataclass
class Staged:
    """Rows that are written but not visible yet."""

    spark: SparkSession
    path: str
    schema: object
    rows: int
    minima: dict = field(default_factory=dict)

    def partitions(self) -> list[str]:
        """Partitions that were written, from a directory listing."""
        fs, p = _fs(self.spark, self.path)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(p)
                      if st.isDirectory() and st.getPath().getName().startswith("partition="))

    def per_partition(self, minima: Sequence[str] = ()) -> DataFrame:
        """partition, rows and ``min_<column>`` of what was written, a row per partition, read from the files."""
        fields = ["partition string", *[f"{c} {self.schema[c].dataType.simpleString()}" for c in minima]]
        if not self.partitions():
            return quality_minima(self.spark.createDataFrame([], ", ".join(fields)), minima, ("partition",), counted=True)
        files = self.spark.read.schema(", ".join(fields)).parquet(self.path)
        return quality_minima(files, minima, ("partition",), counted=True)

    def publish(self, target: str, accepted: Callable[[str], bool] = lambda partition: True) -> list[str]:
        """Replace each accepted partition of ``target`` by the staged one; the rest is discarded.

        A partition is swapped by two renames. One that is interrupted between them is absent until the run,
        which has not committed, is repeated; no reader sees half of it, and no other partition is touched.
        """
        fs, _ = _fs(self.spark, self.path)
        fs.mkdirs(_fs(self.spark, target)[1])

        def move(partition: str) -> str:
            new, old = (_fs(self.spark, f"{base}/partition={partition}")[1] for base in (self.path, target))
            aside = _fs(self.spark, f"{self.path}/_replaced-{partition}")[1]
            if fs.exists(old) and not fs.rename(old, aside):
                raise OSError(f"could not replace {old}")
            if not fs.rename(new, old):
                raise OSError(f"could not move {new} into {target}")
            return partition

        names = [p for p in self.partitions() if accepted(p)]
        with ThreadPoolExecutor(max_workers=MOVES_AT_ONCE) as pool:
            done = list(pool.map(move, names))
        self.discard()
        return done

    def discard(self) -> None:
        fs, p = _fs(self.spark, self.path)
        fs.delete(p, True)


def stage(df: DataFrame, lake: Lake, dataset: str, partition: str | Column, minima: Sequence[str] = ()) -> Staged:
    """Write ``df`` by partition (one value, or a Column giving each row's) where no reader looks.

    ``minima`` are observed during the write, over all of its rows.
    """
    spark = df.sparkSession
    path = f"{lake.root.rstrip('/')}/_ops/staging/{dataset}-{uuid.uuid4().hex}"
    out = df.withColumn("partition", partition if isinstance(partition, Column) else F.lit(partition))
    seen = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.min(c).alias(f"min_{c}") for c in minima])
    if isinstance(partition, Column):
        out = out.hint("rebalance", "partition")
    out.write.partitionBy("partition").parquet(path)
    staged = Staged(spark, path, df.schema, 0, {f"min_{c}": None for c in minima})
    if staged.partitions():  # without rows there is nothing observed
        got = seen.get
        staged.rows, staged.minima = int(got["rows"]), {f"min_{c}": got[f"min_{c}"] for c in minima}
    return staged
