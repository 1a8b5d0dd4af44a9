"""Build the client gold layer from bronze (facts, dimension, margin tables).

Each gold table reads its bronze sources with the chosen scope and is written as one
partition; margin_invoice's partition is the newest of its four sources (O3, Q31).
``scope='current'`` (the default) reads every row of each key's newest batch since the table's newest
full load, from maintained state (:mod:`lakestrata.plans.current`); ``scope='latest'`` reads each table's own newest partition, which after an
incremental run is only a delta (Q29).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession

from lakestrata import schemas
from lakestrata.operators import facts, ledger, margin
from lakestrata.operators.latest import newest_batch_rows
from lakestrata.plans.current import current_rows
from lakestrata.plans.ingest import committed_batches, latest_committed_partition, live_batch_count
from lakestrata.plans.lake import Lake, WriteResult, read_layer, write_gold
from lakestrata.specs import CLIENT_TABLES, Pattern, TableSpec, spec

GOLD_SOURCES = {
    "fact_invoice": ["invoice_item"],
    "fact_invoice_detail": ["invoice_header"],
    "fact_order_item": ["order_item"],
    "dim_customer": ["customer_address"],
    "fact_general_ledger": ["general_ledger"],
    "margin_invoice": ["invoice_item", "invoice_header", "order_item", "customer_address"],
    "margin_rebate": ["general_ledger"],
}


def read_bronze(spark: SparkSession, lake: Lake, table: str, scope: str = "current",
                specs: Iterable[TableSpec] = CLIENT_TABLES) -> tuple[DataFrame, str]:
    """A bronze table (committed batches only) and the partition it stands for.

    The partition is the newest one with a committed run (sync log), so a run that died
    before its commit never makes gold read an empty partition.
    """
    s = spec(table, tuple(specs))
    part = latest_committed_partition(spark, lake, table)
    if part is None:
        raise ValueError(f"No partitions found for {table}")
    if scope == "current":
        return current_rows(spark, lake, s), part
    batches = committed_batches(spark, lake, table)
    df = read_layer(spark, lake, "bronze", table, schemas.BRONZE.get(table), {"latest": "partition"}.get(scope, scope),
                    partition=part, committed_batches=batches)
    if scope == "latest" and s.pattern is Pattern.INCREMENTAL and s.keys \
            and live_batch_count(spark, lake, table, part) > 1:
        # batches of one hour re-read the watermark's boundary second
        df = newest_batch_rows(df, s.keys)
    return df, part


def gold_frame(name: str, sources: dict[str, DataFrame], as_of=None) -> DataFrame:
    if name == "fact_invoice":
        return facts.fact_invoice(sources["invoice_item"])
    if name == "fact_invoice_detail":
        return facts.fact_invoice_detail(sources["invoice_header"])
    if name == "fact_order_item":
        return facts.fact_order_item(sources["order_item"])
    if name == "dim_customer":
        return facts.dim_customer(sources["customer_address"])
    if name == "fact_general_ledger":
        return ledger.fact_general_ledger(sources["general_ledger"], as_of)
    if name == "margin_rebate":
        return ledger.margin_rebate(ledger.fact_general_ledger(sources["general_ledger"], as_of))
    if name == "margin_invoice":
        return margin.margin_invoice(sources["invoice_item"], sources["invoice_header"],
                                     sources["order_item"], sources["customer_address"])
    raise KeyError(name)


def build_gold(spark: SparkSession, lake: Lake, tables: Iterable[str] | None = None,
               scope: str = "current", as_of=None, max_parallel: int = 4) -> dict[str, WriteResult]:
    """Write the selected gold tables (default all); returns path/partition/rows per table.

    The tables are independent, so their jobs are submitted from up to ``max_parallel``
    driver threads (siblings run side by side, as in the reference's gold stage).
    """
    names = list(tables) if tables is not None else list(GOLD_SOURCES)

    def one(name: str) -> WriteResult:
        srcs = GOLD_SOURCES[name]
        frames, parts = {}, []
        for t in srcs:
            frames[t], p = read_bronze(spark, lake, t, scope)
            parts.append(p)
        return write_gold(gold_frame(name, frames, as_of), lake, name, max(parts), srcs)

    if max_parallel <= 1 or len(names) <= 1:
        return {name: one(name) for name in names}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(names))) as pool:
        return dict(zip(names, pool.map(one, names)))
