"""Partition and version selection over layered tables (S12, S13, O2, O3, U1, scope=current).

Every selection here is an aggregate, never a window over raw rows: partial aggregation
collapses a hot key (or a hot partition) to one row per task before the shuffle, so no
single task ever has to hold a whole group.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.timefmt import PARTITION_PATTERN

PARTITION = "partition"


def valid_partition(c: Column) -> Column:
    """Partition names of the form YYYY-MM-DD-HH (others are ignored)."""
    return c.rlike(PARTITION_PATTERN)


def partitions(df: DataFrame, part_col: str = PARTITION) -> DataFrame:
    """Distinct valid partition values of a layered table."""
    return df.select(F.col(part_col).alias(PARTITION)).where(valid_partition(F.col(PARTITION))).distinct()


def partition_list(df: DataFrame, limit: int = 10, part_col: str = PARTITION) -> DataFrame:
    """Newest ``limit`` partitions, newest first (distinct, then top-k)."""
    return partitions(df, part_col).orderBy(F.col(PARTITION).desc()).limit(limit)


def latest_partition_scan(df: DataFrame, part_col: str = PARTITION) -> DataFrame:
    """Rows of the newest valid partition (scope 'latest').

    Expressed with a scalar subquery so Spark prunes partitions at run time. For a lake
    table, :func:`lakestrata.plans.lake.latest_partition_value` lists directories instead
    and filters on a literal (pruned at plan time).
    """
    newest = partitions(df, part_col).agg(F.max(PARTITION).alias("p"))
    return df.where(F.col(part_col) == newest.select("p").scalar())


def current_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Scope 'current': the latest version of every key across all partitions.

    ``max_by(row, (order_by...))`` per key is a declarative aggregate with map-side
    partials: a key that holds a third of all rows still shuffles one row per task.
    Ties must be broken by ``order_by`` (e.g. timestamp, partition, sequence).
    """
    cols = [c for c in df.columns]
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order_by]))
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
        .agg(latest.alias("__row")).select("__row.*")


def whole_key(keys: Sequence[str]) -> Column:
    """True where every key column has a value: a key with a null in it identifies nothing."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def newest_batch_rows(df: DataFrame, keys: Sequence[str], batch_col: str = "batch_id") -> DataFrame:
    """Every row of each key's newest batch: what a batch repeats stays, a null key supersedes nothing.

    Rows with a null in their key bypass the join, so a hot null key is not shuffled.
    """
    known = df.where(whole_key(keys))
    newest = known.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(batch_col).alias("__newest"))
    same = F.col(batch_col) == F.col("__newest")
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"__k{i}"))
    return known.join(newest, same).select(*df.columns).unionByName(df.where(~whole_key(keys)))
