"""Star-schema facts and the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.business import normalize_customer_id, normalize_customer_name
from lakestrata.functions.coerce import (
    PRODUCT, parse_timestamp, strip_ws, to_decimal_or_zero, to_int_or_null,
)


def measures(qty_col: str = "qty_invoiced", price_col: str = "price", cost_col: str = "cost") -> dict:
    """M1/M3: quantity (DECIMAL(18,4)) and the three exact products, wide enough never to overflow."""
    return products(*[to_decimal_or_zero(F.col(c)) for c in (qty_col, price_col, cost_col)])


def products(qty: Column, price: Column, cost: Column) -> dict:
    """M3 of three coerced values."""
    return {
        "QtyInvoiced": qty,
        "ExtendedPrice": (qty * price).cast(PRODUCT),
        "TotalCost": (qty * cost).cast(PRODUCT),
        "Margin": (qty * (price - cost)).cast(PRODUCT),
    }


def fact_invoice(invoice_item: DataFrame) -> DataFrame:
    """Invoice lines -> InvoiceID (trimmed), InvoiceDate (timestamp), measures."""
    m = measures()
    return invoice_item.select(
        strip_ws(F.col("inv_num")).alias("InvoiceID"),
        parse_timestamp(F.col("tax_date")).alias("InvoiceDate"),
        *[expr.alias(name) for name, expr in m.items()],
    )


def fact_invoice_detail(invoice_header: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Header -> InvoiceID (raw, not trimmed: Q10), CustomerID (normalised).

    ``keep`` carries extra columns through (e.g. ``partition`` for all-partition reads).
    """
    return invoice_header.select(
        *keep,
        F.col("inv_num").alias("InvoiceID"),
        normalize_customer_id(F.col("cust_num").cast("int")).alias("CustomerID"),
    )


def fact_order_item(order_item: DataFrame) -> DataFrame:
    """Order lines; OrderLine coerced but not filled (Q6), money coerced to 0."""
    return order_item.select(
        F.col("co_num").alias("OrderNumber"),
        to_int_or_null(F.col("co_line")).alias("OrderLine"),
        F.col("item").alias("ProductID"),
        to_decimal_or_zero(F.col("qty_ordered")).alias("QtyOrdered"),
        to_decimal_or_zero(F.col("qty_shipped")).alias("QtyShipped"),
        to_decimal_or_zero(F.col("cost")).alias("Cost"),
        to_decimal_or_zero(F.col("price")).alias("Price"),
        F.col("description").alias("ProductName"),
    )


def dim_customer(customer_address: DataFrame) -> DataFrame:
    """One row per address row, name normalised."""
    return customer_address.select(
        F.col("cust_num").cast("int").alias("CustomerID"),
        F.col("cust_seq").cast("int").alias("CustomerSequence"),
        normalize_customer_name(F.col("name")).alias("CustomerName"),
    )
