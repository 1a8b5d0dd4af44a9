"""Business rules of the client gold layer as Column expressions.

Look-ups are literal maps folded into the generated code; no join, no Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestrata.functions.coerce import parse_timestamp

# ---------------------------------------------------------------------------
# These must equal the business configuration being reproduced.
# ---------------------------------------------------------------------------
SALES_REBATE_ACCOUNT = "422200"

CUSTOMER_ID_MAPPING = {
    1064: 1015,
    1314: 1005,
}

CUSTOMER_NAME_MAPPING = {
    "CVS CAREMARK": "CVS/Omnicare",
    "OMNICARE": "CVS/Omnicare",
    "Kaleida Health": "Olean General",
    "METHODIST HOSPITAL WESTOVER HILLS / San Antonio Supply Chain": "Methodist Hospital Westover Hills",
    "Methodist Le Bonheur Healthcare": "Methodist Healthcare",
    "O&M Main Street": "Owens",
    "Owens & Minor": "Owens",
}

REBATE_CUSTOMER_ID_MAPPING = {
    "Mckesson": 1004,
    "Cardinal": 1008,
    "Schein": 1030,
    "Medline": 1007,
    "Owens": 1005,
    "Seneca": 1041,
}

REBATE_EXCLUDED_PREFIXES = ("Retro", "Income")

REBATE_EXCLUDED_REFS = ("Owens/Retro Rebate FY 2025",)
# ---------------------------------------------------------------------------


def _literal_map(mapping: dict, key_type: str, value_type: str) -> Column:
    pairs = []
    for key, value in mapping.items():
        pairs += [F.lit(key).cast(key_type), F.lit(value).cast(value_type)]
    return F.create_map(*pairs)


def normalize_customer_id(c: Column) -> Column:
    """Consolidate related customer ids; unmapped ids (and null) pass through."""
    return F.coalesce(F.try_element_at(_literal_map(CUSTOMER_ID_MAPPING, "int", "int"), c), c)


def normalize_customer_name(c: Column) -> Column:
    """Exact, case-sensitive name standardisation; null passes through."""
    return F.coalesce(F.try_element_at(_literal_map(CUSTOMER_NAME_MAPPING, "string", "string"), c), c)


def rebate_cutoff(as_of: _dt.date | str | Column | None = None) -> Column:
    """D3: 1 January of the year before ``as_of`` (default: today), as TIMESTAMP_NTZ."""
    if as_of is None:
        base = F.current_date()
    elif isinstance(as_of, Column):
        base = as_of.cast("date")
    else:
        base = F.lit(str(as_of)).cast("date")
    return F.make_date(F.year(base) - 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")


def rebate_columns(acct: Column, trans_date: Column, ref: Column,
                   as_of: _dt.date | str | Column | None = None) -> tuple[Column, Column]:
    """(RebateCustomerName, RebateCustomerID) for a ledger row.

    The name is the first space-delimited word of ``ref`` when the row is on the rebate
    account, dated on/after the cutoff, not an excluded reference, contains a space,
    and its first word is not an excluded prefix; otherwise ''. The id is the mapped
    rebate customer id, null for '' or unmapped names. An unparsable date is ineligible.
    """
    eligible = F.coalesce(
        (acct.cast("string") == F.lit(SALES_REBATE_ACCOUNT))
        & (parse_timestamp(trans_date) >= rebate_cutoff(as_of)),
        F.lit(False))
    text = F.coalesce(ref.cast("string"), F.lit(""))
    first_word = F.substring_index(text, " ", 1)
    valid = (eligible
             & ~text.isin(*REBATE_EXCLUDED_REFS)
             & text.contains(" ")
             & ~first_word.isin(*REBATE_EXCLUDED_PREFIXES))
    name = F.when(valid, first_word).otherwise(F.lit(""))
    rebate_id = F.when(name != F.lit(""),
                       F.try_element_at(_literal_map(REBATE_CUSTOMER_ID_MAPPING, "string", "int"), name))
    return name, rebate_id.cast("int")
