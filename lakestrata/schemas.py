"""Declared schemas: bronze (dirty text where the source is untyped), silver, gold, logs.

Bronze money/date columns are text on purpose: the reference's JSON hop turns them into
strings and every transform re-coerces. Gold schemas carry the types of the serving-view DDL;
aggregated sums keep Spark's widened precision so that totals cannot overflow at scale.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    MapType, StringType, StructField, StructType, TimestampNTZType,
)

S, I, L = StringType(), IntegerType(), LongType()
TS = TimestampNTZType()
MONEY = DecimalType(18, 4)
PRODUCT = DecimalType(33, 4)  # quantity times money: holds the product of any two MONEY values
SALES_MONEY = DecimalType(18, 2)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# ---- bronze (client ERP) ---------------------------------------------------------------
BRONZE = {
    "invoice_item": _struct(("inv_num", S), ("inv_line", I), ("co_num", S), ("co_line", I), ("item", S),
                            ("tax_date", S), ("qty_invoiced", S), ("price", S), ("cost", S),
                            ("RecordDate", TS)),
    "invoice_header": _struct(("inv_num", S), ("cust_num", I), ("RecordDate", TS)),
    "order_item": _struct(("co_num", S), ("co_line", I), ("item", S), ("qty_ordered", S),
                          ("qty_shipped", S), ("cost", S), ("price", S), ("description", S),
                          ("RecordDate", TS)),
    "customer_address": _struct(("cust_num", I), ("cust_seq", I), ("name", S)),
    "general_ledger": _struct(("trans_num", L), ("acct", S), ("trans_date", S), ("dom_amount", S),
                              ("for_amount", S), ("from_id", S), ("ref", S)),
    "sales": _struct(("order_id", L), ("customer_id", S), ("product", S), ("quantity", I),
                     ("unit_price", SALES_MONEY), ("order_date", DateType()), ("region", S)),
}

# ---- silver ---------------------------------------------------------------------------
SILVER_SALES = _struct(*[(f.name, f.dataType) for f in BRONZE["sales"].fields],
                       ("total_amount", SALES_MONEY), ("processed_at", TS))

# ---- gold (view DDL types) ---------------------------------------------------------------
GOLD = {
    "fact_invoice": _struct(("InvoiceID", S), ("InvoiceDate", TS), ("QtyInvoiced", MONEY),
                            ("ExtendedPrice", PRODUCT), ("TotalCost", PRODUCT), ("Margin", PRODUCT)),
    "fact_invoice_detail": _struct(("InvoiceID", S), ("CustomerID", I)),
    "fact_order_item": _struct(("OrderNumber", S), ("OrderLine", I), ("ProductID", S), ("QtyOrdered", MONEY),
                               ("QtyShipped", MONEY), ("Cost", MONEY), ("Price", MONEY), ("ProductName", S)),
    "dim_customer": _struct(("CustomerID", I), ("CustomerSequence", I), ("CustomerName", S)),
    "margin_invoice": _struct(("Invoice", S), ("CustomerID", I), ("CustomerName", S), ("InvoiceDate", DateType()),
                              ("ProductID", S), ("ProductName", S), ("QtyInvoiced", MONEY),
                              ("ExtendedPrice", PRODUCT), ("TotalCost", PRODUCT), ("Margin", PRODUCT)),
    "fact_general_ledger": _struct(("Account", S), ("Transaction_Date", TS), ("Domestic_Amount", MONEY),
                                   ("Foreign_Amount", MONEY), ("FromID", S), ("Reference", S),
                                   ("RebateCustomerName", S), ("RebateCustomerID", I)),
    "margin_rebate": _struct(("RebateCustomerName", S), ("RebateCustomerID", I),
                             ("Domestic_Amount", DecimalType(28, 4))),
    "sales_by_region": _struct(("region", S), ("order_count", L), ("total_quantity", L),
                               ("total_revenue", DecimalType(28, 2)), ("report_date", DateType())),
    "sales_by_product": _struct(("product", S), ("order_count", L), ("total_quantity", L),
                                ("total_revenue", DecimalType(28, 2)), ("report_date", DateType())),
    "daily_summary": _struct(("report_date", DateType()), ("partition", S), ("total_orders", L),
                             ("total_revenue", DecimalType(28, 2)), ("avg_order_value", DecimalType(18, 4)),
                             ("by_region", MapType(S, DecimalType(28, 2))),
                             ("by_product", MapType(S, DecimalType(28, 2))), ("generated_at", TS)),
}

# ---- operational tables ---------------------------------------------------------------------
SYNC_LOG = _struct(("table_name", S), ("run_id", S), ("status", S), ("sync_type", S), ("mode", S),
                   ("partition", S), ("partition_value", S), ("last_sync_value", TS), ("rows_synced", L),
                   ("sync_duration_seconds", DoubleType()), ("last_sync_at", TS), ("path", S))

LINEAGE = _struct(("target_layer", S), ("target_path", S), ("dataset", S), ("partition", S),
                  ("source_layer", S), ("source_path", S), ("record_count", L),
                  ("source_tables", ArrayType(S)), ("extra", MapType(S, S)), ("written_at", TS))

INGEST_RESULT = _struct(("table", S), ("rows_synced", L), ("mode", S), ("duration_seconds", DoubleType()),
                        ("skipped", BooleanType()), ("path", S), ("error", S))


_SIMPLE = {"string": S, "int": I, "bigint": L, "date": DateType(), "timestamp_ntz": TS}


def with_fields(schema: StructType, *fields: tuple) -> StructType:
    """A copy of ``schema`` with extra nullable fields (StructType.add mutates in place)."""
    out = StructType(list(schema.fields))
    for name, dtype in fields:
        if name not in out.fieldNames():
            out = out.add(name, _SIMPLE.get(dtype, dtype) if isinstance(dtype, str) else dtype)
    return out
