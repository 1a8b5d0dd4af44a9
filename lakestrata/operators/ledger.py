"""General-ledger fact and the rebate aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.business import SALES_REBATE_ACCOUNT, rebate_columns
from lakestrata.functions.coerce import parse_timestamp, to_decimal_or_zero
from lakestrata.operators.joins import drop_null_keys


def fact_general_ledger(general_ledger: DataFrame, as_of=None) -> DataFrame:
    """P5: typed ledger rows with the extracted rebate customer (name, id).

    ``as_of`` fixes the rebate cutoff (1 Jan of the previous year); default today.
    """
    name, rebate_id = rebate_columns(F.col("acct"), F.col("trans_date"), F.col("ref"), as_of)
    return general_ledger.select(
        F.col("acct").cast("string").alias("Account"),
        parse_timestamp(F.col("trans_date")).alias("Transaction_Date"),
        to_decimal_or_zero(F.col("dom_amount")).alias("Domestic_Amount"),
        to_decimal_or_zero(F.col("for_amount")).alias("Foreign_Amount"),
        F.col("from_id").alias("FromID"),
        F.col("ref").alias("Reference"),
        name.alias("RebateCustomerName"),
        rebate_id.alias("RebateCustomerID"),
    )


def margin_rebate(fact_gl: DataFrame) -> DataFrame:
    """A5: rebate totals per (name, id); unmapped names (null id) drop out (Q2).

    Partial aggregation runs map-side, so a hot customer costs one row per task in the
    shuffle. The sum keeps DECIMAL(28,4) so it cannot overflow.
    """
    rebates = fact_gl.where(
        (F.col("Account") == F.lit(SALES_REBATE_ACCOUNT))
        & F.col("RebateCustomerName").isNotNull()
        & (F.col("RebateCustomerName") != F.lit("")))
    rebates = drop_null_keys(rebates, ["RebateCustomerName", "RebateCustomerID"])
    return (rebates.groupBy("RebateCustomerName", "RebateCustomerID")
            .agg(F.coalesce(F.sum("Domestic_Amount"), F.lit(0)).cast("decimal(28,4)").alias("Domestic_Amount")))
