"""Sales flow: silver enrichment and the gold aggregates.

Group keys that are null are dropped (Q2); all-null sums are 0 (Q3); ``order_count``
counts non-null order ids while ``total_orders`` counts rows (Q4). Money stays decimal.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.coerce import SALES_MONEY
from lakestrata.operators.joins import drop_null_keys

REVENUE = "decimal(28,2)"
MEAN = "decimal(18,4)"


def _ts_or_now(now) -> Column:
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(now, Column):
        return now.cast("timestamp_ntz")
    return F.lit(str(now)).cast("timestamp_ntz")


def _date_or_today(report_date) -> Column:
    if report_date is None:
        return F.current_date()
    if isinstance(report_date, Column):
        return report_date.cast("date")
    return F.lit(str(report_date)).cast("date")


def enrich_sales(bronze_sales: DataFrame, now: _dt.datetime | str | None = None) -> DataFrame:
    """total_amount = quantity * unit_price (DECIMAL(18,2)) and processed_at."""
    return bronze_sales.withColumns({
        "total_amount": (F.col("quantity") * F.col("unit_price")).cast(SALES_MONEY),
        "processed_at": _ts_or_now(now),
    })


def _measures() -> list[Column]:
    return [F.count("order_id").alias("order_count"),
            F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_quantity"),
            F.coalesce(F.sum("total_amount"), F.lit(0)).cast(REVENUE).alias("total_revenue")]


def sales_by(silver: DataFrame, key: str, report_date=None, ordered: bool = False) -> DataFrame:
    """A1/A2 + P7: order_count, total_quantity, total_revenue per ``key`` + report_date.

    ``ordered`` (O4) sorts by key for presentation only; stored tables stay unsorted.
    """
    out = (drop_null_keys(silver, [key]).groupBy(key).agg(*_measures())
           .withColumn("report_date", _date_or_today(report_date)))
    return out.orderBy(key) if ordered else out


def sales_by_region(silver: DataFrame, report_date=None) -> DataFrame:
    return sales_by(silver, "region", report_date)


def sales_by_product(silver: DataFrame, report_date=None) -> DataFrame:
    return sales_by(silver, "product", report_date)


def summary_totals(silver: DataFrame, report_date=None, partition: str | None = None) -> DataFrame:
    """A3: the summary scalars (one row, global aggregate with map-side partials)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast(REVENUE).alias("total_revenue"),
        F.round(F.avg("total_amount"), 4).cast(MEAN).alias("avg_order_value"),
    ).select(_date_or_today(report_date).alias("report_date"),
             F.lit(partition).cast("string").alias("partition"),
             "total_orders", "total_revenue", "avg_order_value")


def summary_breakdown(silver: DataFrame, key: str) -> DataFrame:
    """A4 in long form: revenue per key (the summary document's map, one row per entry)."""
    return (drop_null_keys(silver, [key]).groupBy(key)
            .agg(F.coalesce(F.sum("total_amount"), F.lit(0)).cast(REVENUE).alias("total_revenue")))


def sales_rollup(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A1+A2+A3 in one pass: totals by region, by product and overall.

    Returns ``grouping`` in {'region', 'product', 'total'}, ``key`` and the measures.
    Null keys inside the region/product sets are dropped (Q2). With ``by`` (e.g.
    ``["partition"]``) every set is also grouped by those columns.

    The rows are summed once by (region, product), with map-side partials, and only that small result
    is multiplied by the three sets. An average is the sum over the count, rounded as the average of
    DECIMAL(18,2) is.
    """
    by = list(by)
    cells = silver.groupBy(*by, "region", "product").agg(
        F.count("order_id").alias("orders"), F.sum("quantity").alias("quantity"),
        F.sum("total_amount").cast(REVENUE).alias("revenue"), F.count("total_amount").alias("amounts"),
        F.count(F.lit(1)).alias("n"))
    sets = F.array(*[F.struct(F.lit(g).alias("grouping"), k.cast("string").alias("key")) for g, k in (
        ("region", F.col("region")), ("product", F.col("product")), ("total", F.lit(None)))])
    revenue, amounts = F.sum("revenue"), F.sum("amounts")
    mean = F.round(F.when(amounts > 0, revenue.cast("decimal(28,10)") / amounts.cast("decimal(10,0)")), 6)
    return (cells.select(*by, F.explode(sets).alias("s"), "orders", "quantity", "revenue", "amounts", "n")
            .where((F.col("s.grouping") == "total") | F.col("s.key").isNotNull())
            .groupBy(*by, F.col("s.grouping").alias("grouping"), F.col("s.key").alias("key")).agg(
                F.sum("orders").alias("order_count"),
                F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_quantity"),
                F.coalesce(revenue, F.lit(0)).cast(REVENUE).alias("total_revenue"),
                F.sum("n").alias("total_orders"), F.round(mean, 4).cast(MEAN).alias("avg_order_value")))


def summary_document(silver: DataFrame, report_date=None, partition: str | None = None,
                     now=None, max_keys: int | None = None) -> DataFrame:
    """A3+A4 as one row with ``by_region`` / ``by_product`` maps (the JSON summary document).

    Built from the one-scan :func:`sales_rollup`. The maps hold one entry per distinct key in a single
    row; :func:`summary_breakdown` is the same in long form, and ``max_keys`` refuses wider documents.
    """
    return summary_from_rollup(sales_rollup(silver), report_date, partition, now, max_keys)


def summary_from_rollup(rollup: DataFrame, report_date=None, partition: str | None = None,
                        now=None, max_keys: int | None = None) -> DataFrame:
    """The summary document from a (small, possibly checkpointed) :func:`sales_rollup`:
    the per-partition builder over one constant partition."""
    return summary_documents_from_rollup(rollup, report_date, now, max_keys, by=None, partition=partition)


def by_key_from_rollup(rollup: DataFrame, key: str, report_date=None, by: Sequence[str] = ()) -> DataFrame:
    """A1/A2 from the one-pass rollup: the rows of one grouping set (per ``by`` group)."""
    return (rollup.where(F.col("grouping") == key)
            .select(*by, F.col("key").alias(key), "order_count", "total_quantity", "total_revenue")
            .withColumn("report_date", _date_or_today(report_date)))


def summary_documents_from_rollup(rollup: DataFrame, report_date=None, now=None,
                                  max_keys: int | None = None, by: str | None = "partition",
                                  partition: str | None = None) -> DataFrame:
    """Summary documents, one per ``by`` value, from a ``sales_rollup(..., [by])``;
    with ``by=None`` one document (named ``partition``) from a global aggregate, which
    also gives a zero document for empty input.

    One aggregate per partition builds the scalars and the two maps. A caller that wants no document
    past ``max_keys`` keys in one map says so; by default every partition gets its document.
    """
    if max_keys is not None:
        keys = rollup.where(F.col("grouping") != "total").groupBy(*([by] if by else []), "grouping").count()
        widest = keys.agg(F.max("count").alias("n")).first().n
        if widest is not None and widest > max_keys:
            raise ValueError(f"a partition has more than {max_keys} keys: too many for one summary document")

    def entries(grouping: str) -> Column:
        entry = F.when(F.col("grouping") == grouping, F.struct(F.col("key"), F.col("total_revenue")))
        return F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(f"by_{grouping}")

    return summary_scalars(rollup, report_date, now, by, partition, entries("region"), entries("product"))


def summary_scalars(rollup: DataFrame, report_date=None, now=None, by: str | None = "partition",
                    partition: str | None = None, *more: Column) -> DataFrame:
    """The totals of a summary per ``by`` value (``by=None``: one row, also for empty input), and ``more``
    aggregates of the roll-up."""
    def scalar(name: str) -> Column:
        return F.max(F.when(F.col("grouping") == "total", F.col(name))).alias(name)

    docs = (rollup.groupBy(by) if by else rollup).agg(
        scalar("total_orders"), scalar("total_revenue"), scalar("avg_order_value"), *more)
    name = F.col(by) if by else F.lit(partition).cast("string")
    known = {by, "total_orders", "total_revenue", "avg_order_value"}
    return docs.select(_date_or_today(report_date).alias("report_date"), name.alias("partition"),
                       F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
                       F.coalesce(F.col("total_revenue"), F.lit(0)).cast(REVENUE).alias("total_revenue"),
                       "avg_order_value", *[c for c in docs.columns if c not in known],
                       _ts_or_now(now).alias("generated_at"))
