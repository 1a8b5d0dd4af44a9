"""Typed serving views over gold / silver datasets.

Each view reads every partition of its dataset (``scope='all'``, like a wildcard over
all partition folders) or only the newest (``scope='latest'``), and applies the column
types of the serving DDL. Ids that may arrive as float text ('1008.0') go through C1.
Numeric narrowing uses ANSI casts, so an overflow fails loudly instead of turning null.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from lakestrata import schemas
from lakestrata.functions.coerce import WHITESPACE, id_from_text
from lakestrata.plans.lake import Lake, exists, latest_partition_value

M4, M2 = "decimal(18,4)", "decimal(18,2)"
PRODUCT = "decimal(33,4)"  # quantity times money

# view -> (layer, dataset, [(column, type)]); type "id" = text-or-number id
VIEWS: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "fact_invoice": ("gold", "fact_invoice", [
        ("InvoiceID", "string"), ("InvoiceDate", "date"), ("QtyInvoiced", M4), ("ExtendedPrice", PRODUCT),
        ("TotalCost", PRODUCT), ("Margin", PRODUCT)]),
    "fact_invoice_detail": ("gold", "fact_invoice_detail", [("InvoiceID", "string"), ("CustomerID", "int")]),
    "fact_order_item": ("gold", "fact_order_item", [
        ("OrderNumber", "string"), ("OrderLine", "int"), ("ProductID", "string"), ("QtyOrdered", M4),
        ("QtyShipped", M4), ("Cost", M4), ("Price", M4), ("ProductName", "string")]),
    "dim_customer": ("gold", "dim_customer", [
        ("CustomerID", "int"), ("CustomerSequence", "int"), ("CustomerName", "string")]),
    "margin_invoice": ("gold", "margin_invoice", [
        ("Invoice", "string"), ("CustomerID", "int"), ("CustomerName", "string"), ("InvoiceDate", "date"),
        ("ProductID", "string"), ("ProductName", "string"), ("QtyInvoiced", M4), ("ExtendedPrice", PRODUCT),
        ("TotalCost", PRODUCT), ("Margin", PRODUCT)]),
    "fact_general_ledger": ("gold", "fact_general_ledger", [
        ("Account", "string"), ("Transaction_Date", "date"), ("Domestic_Amount", M4), ("Foreign_Amount", M4),
        ("FromID", "string"), ("Reference", "string"), ("RebateCustomerName", "string"),
        ("RebateCustomerID", "id")]),
    "margin_rebate": ("gold", "margin_rebate", [
        ("RebateCustomerName", "string"), ("RebateCustomerID", "id"), ("Domestic_Amount", M4)]),
    "sales_by_region": ("gold", "sales_by_region", [
        ("region", "string"), ("order_count", "bigint"), ("total_quantity", "bigint"),
        ("total_revenue", "decimal(28,2)"), ("report_date", "string")]),
    "sales_by_product": ("gold", "sales_by_product", [
        ("product", "string"), ("order_count", "bigint"), ("total_quantity", "bigint"),
        ("total_revenue", "decimal(28,2)"), ("report_date", "string")]),
    "silver_sales": ("silver", "sales", [
        ("order_id", "string"), ("customer_id", "string"), ("product", "string"), ("quantity", "int"),
        ("unit_price", M2), ("order_date", "string"), ("region", "string"), ("total_amount", M2),
        ("processed_at", "string")]),
}


def typed_column(df: DataFrame, name: str, dtype: str) -> Column:
    c = F.col(name)
    if dtype == "id":
        return (id_from_text(c) if isinstance(df.schema[name].dataType, StringType) else c.cast("int")).alias(name)
    if isinstance(df.schema[name].dataType, StringType) and dtype != "string":
        return c.try_cast(dtype).alias(name)  # text sources (CSV): unparsable -> null
    return c.cast(dtype).alias(name)


def typed_view_frame(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Apply a view's column list and types to a frame (columns missing -> typed null)."""
    out = []
    for name, dtype in columns:
        if name in df.columns:
            out.append(typed_column(df, name, dtype))
        else:
            out.append(F.lit(None).cast("int" if dtype == "id" else dtype).alias(name))
    return df.select(*out)


def _view_sql(fields: dict[str, DataType], columns: list[tuple[str, str]]) -> str:
    """The column list of :func:`typed_view_frame` as SQL text, for views that outlive the session."""
    blanks = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)
    out = []
    for name, dtype in columns:
        kind = "int" if dtype == "id" else dtype
        text = isinstance(fields.get(name), StringType)
        if name not in fields:
            value = f"CAST(NULL AS {kind})"
        elif dtype == "id" and text:
            value = f"try_cast(try_cast(nullif(trim(BOTH '{blanks}' FROM `{name}`), '') AS decimal(10,0)) AS int)"
        elif text and dtype != "string":
            value = f"try_cast(`{name}` AS {kind})"
        else:
            value = f"CAST(`{name}` AS {kind})"
        out.append(f"{value} AS `{name}`")
    return ", ".join(out)


def create_views(spark: SparkSession, lake: Lake, views: Iterable[str] | None = None,
                 scope: str = "all", persistent: bool = False) -> dict[str, str]:
    """V0: create or replace the named (default: all) views; status per view.

    'created', 'skipped' (dataset not written yet), 'error' (unknown name) or 'error: ' and the reason.
    """
    results = {}
    for name in (list(views) if views is not None else list(VIEWS)):
        if name not in VIEWS:
            results[name] = "error"
            continue
        layer, dataset, columns = VIEWS[name]
        path = lake.path(layer, dataset)
        try:
            if not exists(spark, path):
                results[name] = "skipped"
                continue
            declared = schemas.GOLD.get(dataset) if layer == "gold" else schemas.SILVER_SALES
            reader = spark.read if declared is None else spark.read.schema(
                schemas.with_fields(declared, ("partition", "string")))
            df = reader.parquet(path)
            if scope == "latest":
                df = df.where(F.col("partition") == F.lit(latest_partition_value(spark, path)))
            if persistent:  # in the session's catalog: other sessions of the metastore see it
                newest = f" WHERE `partition` = (SELECT max(`partition`) FROM parquet.`{path}`)" if scope == "latest" else ""
                fields = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
                spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT {_view_sql(fields, columns)} "
                          f"FROM parquet.`{path}`{newest}")
            else:
                typed_view_frame(df, columns).createOrReplaceTempView(name)
            results[name] = "created"
        except Exception as e:  # noqa: BLE001 - one failing view must not hide the others
            results[name] = f"error: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
    return results


def sample_views(spark: SparkSession, names: Iterable[str], n: int = 5) -> dict[str, DataFrame]:
    """A few rows of each published view (a sample is the feature here)."""
    return {name: spark.table(name).limit(n) for name in names}
