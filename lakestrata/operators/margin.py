"""The denormalised margin table: invoice lines + header + order line + customer.

Semantics (pandas left merges, null keys match null keys):

    item ⟕[inv_num <=>] header ⟕[co_num, co_line <=>] order_item ⟕[cust_num <=>] address(cust_seq = 0)

Physical plan. The invoice lines are the big side; every join that re-keys them is a full
shuffle of the fact. The customer look-up only needs the header's cust_num, so it is moved
onto the (much smaller) header side first:

    header* = header ⟕[cust_num <=>] address0          (header-sized join)
    result  = item ⟕[inv_num <=>] header* ⟕[co keys <=>] order_item

That is two fact shuffles instead of three, and invoice lines without a header (null
cust_num after the first join) are never funnelled into one reducer by a null key. The lines carry
three coerced values through the joins; the products, twice as wide, are made behind the last one. The
two plans would differ only for lines without a header when the address table has primary rows
with a null cust_num ("orphans"): those lines pick up every orphan name. They get them from one
more equality join, on a salt: every orphan row appears under each of SALTS salts, a line without
a header looks under one of them, all other lines under a key of their own that no orphan has. So
the planner broadcasts the orphans if the address table is within its threshold, and else sorts and
merges, without a hot key, at the price of one more shuffle of the lines.
The plan is the same at every size and building it runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.business import normalize_customer_id, normalize_customer_name
from lakestrata.functions.coerce import col_or_null, parse_timestamp, strip_ws, to_decimal_or_zero
from lakestrata.operators.facts import products
from lakestrata.operators.joins import null_safe_join, prefixed


def _item_side(item: DataFrame) -> DataFrame:
    """Invoice lines reduced to join keys + typed values before any shuffle.

    The date and the three values that the measures are products of depend only on the line itself, so
    they are coerced here: the fact is shuffled with a DATE and three DECIMAL(18,4) values instead of
    four text fields, or of products of twice that width.
    """
    return item.select("inv_num",
                       col_or_null(item, "co_num").alias("co_num"),
                       col_or_null(item, "co_line", "int").alias("co_line"),
                       col_or_null(item, "item").alias("item"),
                       F.to_date(parse_timestamp(F.col("tax_date"))).alias("InvoiceDate"),
                       *[to_decimal_or_zero(F.col(c)).alias(c) for c in VALUES])


def _primary_addresses(address: DataFrame) -> DataFrame:
    return prefixed(address.where(F.col("cust_seq") == 0), "a_", ["cust_num", "name"])


def _project(joined: DataFrame) -> DataFrame:
    return joined.select(
        strip_ws(F.col("inv_num")).alias("Invoice"),
        normalize_customer_id(F.col("h_cust_num").cast("int")).alias("CustomerID"),
        normalize_customer_name(F.col("a_name")).alias("CustomerName"),
        "InvoiceDate",
        F.col("item").alias("ProductID"),
        F.col("o_description").alias("ProductName"),
        *[expr.alias(name) for name, expr in products(*[F.col(c) for c in VALUES]).items()],
    )


SALTS = 64
VALUES = ["qty_invoiced", "price", "cost"]


def _join_order_item(df: DataFrame, order_item: DataFrame, has_co: bool) -> DataFrame:
    if not has_co:  # C2: no order keys on the lines -> no description (Q16)
        return df.withColumn("o_description", F.lit(None).cast("string"))
    o = prefixed(order_item, "o_", ["co_num", "co_line", "description"])
    return null_safe_join(df, o, [("co_num", "o_co_num"), ("co_line", "o_co_line")]).drop("o_co_num", "o_co_line")


def margin_invoice(invoice_item: DataFrame, invoice_header: DataFrame, order_item: DataFrame,
                   customer_address: DataFrame, strategy: str = "auto") -> DataFrame:
    """The 10-column margin table.

    ``strategy='literal'`` is the plain three-join plan instead of the header-first one ('auto'); both
    give identical rows.
    """
    item = _item_side(invoice_item)
    has_co = "co_num" in invoice_item.columns and "co_line" in invoice_item.columns
    header = prefixed(invoice_header, "h_", ["inv_num", "cust_num"])
    address0 = _primary_addresses(customer_address)

    if strategy not in ("auto", "literal"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "literal":
        j = null_safe_join(item, header, [("inv_num", "h_inv_num")])
        j = _join_order_item(j, order_item, has_co)
        j = null_safe_join(j, address0, [("h_cust_num", "a_cust_num")])
        return _project(j)

    # header_first: resolve the customer name on the header side.
    header_named = (null_safe_join(header, address0, [("h_cust_num", "a_cust_num")])
                    .drop("a_cust_num").withColumn("_hdr", F.lit(True)))
    j = null_safe_join(item, header_named, [("inv_num", "h_inv_num")])
    j = _join_order_item(j, order_item, has_co)
    orphan_names = (address0.where(F.col("a_cust_num").isNull())
                    .select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("_orphan_key"),
                            F.col("a_name").alias("_orphan_name")))
    spread = F.xxhash64("inv_num", "co_num", "co_line", "item")
    own = -F.shiftrightunsigned(spread, 1) - 1
    j = (j.withColumn("_key", F.when(F.col("_hdr").isNull(), F.pmod(spread, F.lit(SALTS))).otherwise(own))
         .join(orphan_names, F.col("_key") == F.col("_orphan_key"), "left")
         .withColumn("a_name", F.when(F.col("_hdr").isNull(), F.col("_orphan_name")).otherwise(F.col("a_name"))))
    return _project(j)
