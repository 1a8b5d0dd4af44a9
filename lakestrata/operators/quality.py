"""Data-quality gates and audits."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A batch failed a data-quality gate; nothing was committed."""


def quality_minima(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                   counted: bool = False) -> DataFrame:
    """``min_<col>`` per column (nulls ignored; empty input gives nulls).

    One row, or one row per ``by`` group (e.g. the partitions a micro-batch touches);
    ``counted`` adds the group's row count as ``rows`` in the same pass.
    """
    aggs = [F.min(F.col(c)).alias(f"min_{c}") for c in columns]
    if counted:
        aggs.append(F.count(F.lit(1)).alias("rows"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def check_minima(rows: Sequence, columns: Sequence[str]) -> dict:
    """X1 on collected minima rows (one per group): each column's overall minimum must be > 0.

    Empty or all-null input fails, as does any value <= 0 (Q33).
    """
    out = {}
    for c in columns:
        values = [r[f"min_{c}"] for r in rows if r[f"min_{c}"] is not None]
        if not values:
            raise QualityError(f"{c}: no values (empty or all-null batch)")
        value = min(values)
        if value <= 0:
            raise QualityError(f"{c} must be positive (min {value})")
        out[f"min_{c}"] = value
    return out


def assert_positive(df: DataFrame, columns: Sequence[str] = ("quantity", "unit_price")) -> dict:
    """Fail the batch unless every listed column has a positive minimum (Q33).

    One aggregate job with map-side partials; returns the minima.
    """
    return check_minima([quality_minima(df, columns).first()], columns)


def bronze_audit(expected: DataFrame, counts: DataFrame, lineage: DataFrame,
                 raw_counts: DataFrame | None = None) -> DataFrame:
    """Status of every expected (table, partition): MISSING / EMPTY / OK / ERROR + metadata check.

    ``expected``: table_name, partition. ``counts``: table_name, partition, record_count
    (readable rows). ``lineage``: dataset, partition. Optional ``raw_counts`` (same shape
    as ``counts``, every row on disk): a partition with rows on disk but none readable is
    ERROR (e.g. only batches of runs that died before their commit). All inputs are
    per-partition summaries (small), so this is a few left joins of small frames.
    """
    exp = expected.select("table_name", "partition").distinct()
    cnt = counts.groupBy("table_name", "partition").agg(F.sum("record_count").alias("record_count"))
    lin = lineage.select(F.col("dataset").alias("table_name"), "partition").distinct() \
        .withColumn("_meta", F.lit(True))
    j = exp.join(cnt, ["table_name", "partition"], "left").join(lin, ["table_name", "partition"], "left")
    exists = F.col("record_count").isNotNull()
    status = F.when(~exists, F.lit("MISSING"))
    if raw_counts is not None:
        raw = raw_counts.groupBy("table_name", "partition").agg(F.sum("record_count").alias("_raw"))
        j = j.join(raw, ["table_name", "partition"], "left")
        status = F.when(~exists & (F.coalesce(F.col("_raw"), F.lit(0)) > 0), F.lit("ERROR")) \
            .when(~exists, F.lit("MISSING"))
    return j.select(
        F.col("table_name").alias("table"), "partition",
        status.when(F.col("record_count") == 0, F.lit("EMPTY")).otherwise(F.lit("OK")).alias("status"),
        F.coalesce(F.col("record_count"), F.lit(0)).cast("bigint").alias("record_count"),
        F.when(exists, F.col("_meta").isNull()).alias("metadata_missing"))


def verification_report(summary: DataFrame, stale: DataFrame, latest: DataFrame | None = None,
                        audit: DataFrame | None = None) -> DataFrame:
    """The verification report as ONE long DataFrame (section, table, metric, value).

    Unions the sync summary (X3), stale tables (X4), optional per-table latest state and
    bronze audit rows (X2); printing is just ``.show()`` on the result.
    """
    def long(df: DataFrame, section: str, table_col: str | None) -> DataFrame:
        metrics = [c for c in df.columns if c != table_col]
        stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value"))
                                      for m in metrics]))
        table = F.col(table_col).cast("string") if table_col else F.lit(None).cast("string")
        return df.select(F.lit(section).alias("section"), table.alias("table"), stacked.alias("kv")) \
            .select("section", "table", "kv.metric", "kv.value")

    parts = [long(summary, "sync_summary", None), long(stale, "stale", "table")]
    if latest is not None:
        parts.append(long(latest, "table_state", "table_name"))
    if audit is not None:
        parts.append(long(audit.withColumn("table", F.concat_ws("/", "table", "partition")).drop("partition"),
                          "bronze_audit", "table"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
