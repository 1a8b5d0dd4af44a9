"""Join helpers with the null semantics of the reproduced flows (Q1, Q2)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame,
                        pairs: Sequence[tuple[str, str]]) -> Column:
    """``l1 <=> r1 AND l2 <=> r2 ...``: null keys match null keys (pandas-merge semantics).

    Catalyst keeps this an equi-join (keys become ``coalesce(k, default), isnull(k)``), so
    it still hash-partitions / broadcasts like a plain equality join.
    """
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


def null_safe_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                   how: str = "left") -> DataFrame:
    """Join on null-safe equality of ``pairs`` (left column, right column).

    Column names must not collide: project / prefix the right side first (Q17).
    """
    return left.join(right, null_safe_condition(left, right, pairs), how)


def prefixed(df: DataFrame, prefix: str, columns: Iterable[str]) -> DataFrame:
    """Project ``columns`` renamed with ``prefix`` (column pruning before a join)."""
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all non-null (a group-by drops null-key rows, Q2)."""
    if not keys:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
