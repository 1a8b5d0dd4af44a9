"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the documented semantics, not generated from the Spark plans. Fixture
inputs are CTEs (see :mod:`lakestrata.sources.fixtures`); only raw tables are views.
"""

from __future__ import annotations

from lakestrata.sources.fixtures import (
    FIXED_AS_OF, FIXED_CUTS, FIXED_NOW, FIXED_PARTITION, FIXED_REPORT_DATE, fixture_sql, oracle_cte,
)
from lakestrata.specs import CLIENT_TABLES


# Fixed values of the business rules, written out here so that a wrong constant in the engine shows.
SALES_REBATE_ACCOUNT = "422200"
CUSTOMER_ID_MAPPING = {1064: 1015, 1314: 1005}
CUSTOMER_NAME_MAPPING = {
    "CVS CAREMARK": "CVS/Omnicare", "OMNICARE": "CVS/Omnicare", "Kaleida Health": "Olean General",
    "METHODIST HOSPITAL WESTOVER HILLS / San Antonio Supply Chain": "Methodist Hospital Westover Hills",
    "Methodist Le Bonheur Healthcare": "Methodist Healthcare", "O&M Main Street": "Owens", "Owens & Minor": "Owens",
}
REBATE_CUSTOMER_ID_MAPPING = {"Mckesson": 1004, "Cardinal": 1008, "Schein": 1030, "Medline": 1007, "Owens": 1005,
                              "Seneca": 1041}
REBATE_EXCLUDED_PREFIXES = ("Retro", "Income")
REBATE_EXCLUDED_REFS = ("Owens/Retro Rebate FY 2025",)


def ctes(names, extra: dict[str, str] | None = None) -> str:
    """WITH clause: the named fixtures followed by ``extra`` derived CTEs."""
    parts = [f"{n} AS ({fixture_sql(n, 'duckdb')})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {expr} END"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


NUM0 = "COALESCE(TRY_CAST({} AS DECIMAL(18,4)), CAST(0 AS DECIMAL(18,4)))"
TS = "TRY_CAST({} AS TIMESTAMP)"


def _measures(q: str, p: str, c: str) -> str:
    qn, pn, cn = NUM0.format(q), NUM0.format(p), NUM0.format(c)
    return (f"{qn} AS QtyInvoiced, CAST({qn} * {pn} AS DECIMAL(33,4)) AS ExtendedPrice, "
            f"CAST({qn} * {cn} AS DECIMAL(33,4)) AS TotalCost, "
            f"CAST({qn} * ({pn} - {cn}) AS DECIMAL(33,4)) AS Margin")


MARGIN_BODY = f"""
SELECT trim(i.inv_num) AS Invoice,
       CAST({_case_map('h.cust_num', CUSTOMER_ID_MAPPING)} AS INTEGER) AS CustomerID,
       {_case_map('a.name', CUSTOMER_NAME_MAPPING)} AS CustomerName,
       CAST({TS.format('i.tax_date')} AS DATE) AS InvoiceDate,
       i.item AS ProductID, o.description AS ProductName,
       {_measures('i.qty_invoiced', 'i.price', 'i.cost')}
FROM invoice_item i
LEFT JOIN invoice_header h ON i.inv_num IS NOT DISTINCT FROM h.inv_num
LEFT JOIN order_item o ON i.co_num IS NOT DISTINCT FROM o.co_num AND i.co_line IS NOT DISTINCT FROM o.co_line
LEFT JOIN (SELECT cust_num, name FROM customer_address WHERE cust_seq = 0) a
       ON h.cust_num IS NOT DISTINCT FROM a.cust_num"""

MARGIN_INVOICE = oracle_cte("invoice_item", "invoice_header", "order_item", "customer_address") + MARGIN_BODY

FACT_INVOICE = oracle_cte("invoice_item") + f"""
SELECT trim(inv_num) AS InvoiceID, {TS.format('tax_date')} AS InvoiceDate,
       {_measures('qty_invoiced', 'price', 'cost')}
FROM invoice_item"""

FACT_INVOICE_DETAIL = oracle_cte("invoice_header") + f"""
SELECT inv_num AS InvoiceID, CAST({_case_map('cust_num', CUSTOMER_ID_MAPPING)} AS INTEGER) AS CustomerID
FROM invoice_header"""

FACT_ORDER_ITEM = oracle_cte("order_item") + f"""
SELECT co_num AS OrderNumber, TRY_CAST(co_line AS INTEGER) AS OrderLine, item AS ProductID,
       {NUM0.format('qty_ordered')} AS QtyOrdered, {NUM0.format('qty_shipped')} AS QtyShipped,
       {NUM0.format('cost')} AS Cost, {NUM0.format('price')} AS Price, description AS ProductName
FROM order_item"""

DIM_CUSTOMER = oracle_cte("customer_address") + f"""
SELECT cust_num AS CustomerID, cust_seq AS CustomerSequence,
       {_case_map('name', CUSTOMER_NAME_MAPPING)} AS CustomerName
FROM customer_address"""

_REBATE_NAME = f"""CASE WHEN acct = {_q(SALES_REBATE_ACCOUNT)}
            AND {TS.format('trans_date')} >= TIMESTAMP '{int(FIXED_AS_OF[:4]) - 1}-01-01 00:00:00'
            AND COALESCE(ref, '') NOT IN {_in(REBATE_EXCLUDED_REFS)}
            AND strpos(COALESCE(ref, ''), ' ') > 0
            AND split_part(COALESCE(ref, ''), ' ', 1) NOT IN {_in(REBATE_EXCLUDED_PREFIXES)}
       THEN split_part(COALESCE(ref, ''), ' ', 1) ELSE '' END"""

_REBATE_ID = ("CASE n " + " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in REBATE_CUSTOMER_ID_MAPPING.items())
              + " ELSE NULL END")

FACT_GENERAL_LEDGER = oracle_cte("general_ledger") + f"""
SELECT Account, Transaction_Date, Domestic_Amount, Foreign_Amount, FromID, Reference,
       n AS RebateCustomerName, CAST({_REBATE_ID} AS INTEGER) AS RebateCustomerID
FROM (SELECT acct AS Account, {TS.format('trans_date')} AS Transaction_Date,
             {NUM0.format('dom_amount')} AS Domestic_Amount, {NUM0.format('for_amount')} AS Foreign_Amount,
             from_id AS FromID, ref AS Reference, {_REBATE_NAME} AS n
      FROM general_ledger) g"""

MARGIN_REBATE = f"""
SELECT RebateCustomerName, RebateCustomerID, CAST(SUM(Domestic_Amount) AS DECIMAL(28,4)) AS Domestic_Amount
FROM ({FACT_GENERAL_LEDGER}) f
WHERE Account = {_q(SALES_REBATE_ACCOUNT)} AND RebateCustomerName <> ''
  AND RebateCustomerName IS NOT NULL AND RebateCustomerID IS NOT NULL
GROUP BY RebateCustomerName, RebateCustomerID"""

SILVER_SALES = oracle_cte("sales") + f"""
SELECT order_id, customer_id, product, quantity, unit_price, order_date, region,
       CAST(quantity * unit_price AS DECIMAL(18,2)) AS total_amount,
       TIMESTAMP '{FIXED_NOW}' AS processed_at
FROM sales"""


def _sales_by(key: str) -> str:
    return f"""
SELECT {key}, CAST(COUNT(order_id) AS BIGINT) AS order_count,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
       CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue,
       DATE '{FIXED_REPORT_DATE}' AS report_date
FROM ({SILVER_SALES}) s WHERE {key} IS NOT NULL GROUP BY {key}"""


DAILY_SUMMARY = f"""
SELECT DATE '{FIXED_REPORT_DATE}' AS report_date, '{FIXED_PARTITION}' AS "partition",
       CAST(COUNT(*) AS BIGINT) AS total_orders,
       CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue,
       CAST(ROUND(AVG(total_amount), 4) AS DECIMAL(18,4)) AS avg_order_value
FROM ({SILVER_SALES}) s"""


def _breakdown(key: str) -> str:
    return f"""
SELECT {key}, CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue
FROM ({SILVER_SALES}) s WHERE {key} IS NOT NULL GROUP BY {key}"""


PARTITION_RE = r"'^\d{4}-\d{2}-\d{2}-\d{2}$'"


def _watermark(t: str) -> str:
    return (f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS \"rows\", "
            f"date_trunc('second', max(RecordDate)) AS watermark, "
            f"COALESCE(strftime(max(RecordDate), '%Y-%m-%d %H:%M:%S'), '1900-01-01') AS watermark_sql FROM {t}")


_LATEST_BY_TABLE = "SELECT table_name, max(last_sync_at) AS l, sum(rows_synced) AS t FROM sync_log GROUP BY table_name"
_REGISTERED = "(VALUES " + ", ".join(f"('{s.target_table}')" for s in CLIENT_TABLES) + ") r(table_name)"

SYNC_SUMMARY_BODY = f"""
SELECT CAST(count(*) AS BIGINT) AS total_tables, CAST(COALESCE(sum(t), 0) AS BIGINT) AS total_rows_synced,
       min(l) AS oldest_sync, max(l) AS newest_sync
FROM ({_LATEST_BY_TABLE}) s"""

STALE_BODY = f"""
SELECT table_name AS "table", l AS last_sync,
       CASE WHEN l IS NOT NULL THEN round(date_diff('second', l, TIMESTAMP '{FIXED_NOW}') / 3600.0, 1) END AS hours_ago,
       CASE WHEN l IS NULL THEN 'Never synced' ELSE 'Sync older than 24h' END AS reason
FROM {_REGISTERED} FULL JOIN ({_LATEST_BY_TABLE}) s USING (table_name)
WHERE l IS NULL OR l < TIMESTAMP '{FIXED_NOW}' - INTERVAL 24 HOUR"""

NEW = {
    "ingest_full_filtered": oracle_cte("general_ledger") + "SELECT * FROM general_ledger WHERE acct = '422200'",
    "ingest_incremental": oracle_cte("invoice_item", "sync_log") + """
SELECT * FROM invoice_item
WHERE RecordDate > (SELECT date_trunc('second', max(last_sync_at)) FROM sync_log WHERE table_name = 'invoice_item')""",
    "ingest_date_partition": oracle_cte("sales") + "SELECT * FROM sales WHERE order_date = DATE '1996-01-02'",
    "incremental_watermark": oracle_cte("invoice_item", "invoice_header", "order_item")
    + "\nUNION ALL\n".join(_watermark(t) for t in ("invoice_item", "invoice_header", "order_item")),
    "latest_partition_scan": oracle_cte("bronze_invoice_header") + f"""
SELECT * FROM bronze_invoice_header
WHERE "partition" = (SELECT max("partition") FROM bronze_invoice_header
                     WHERE regexp_matches("partition", {PARTITION_RE}))""",
    "partition_list": oracle_cte("bronze_invoice_header") + f"""
SELECT DISTINCT "partition" FROM bronze_invoice_header WHERE regexp_matches("partition", {PARTITION_RE})
ORDER BY 1 DESC LIMIT 10""",
    "gold_all_partitions": oracle_cte("bronze_invoice_header") + f"""
SELECT "partition", inv_num AS InvoiceID, CAST({_case_map('cust_num', CUSTOMER_ID_MAPPING)} AS INTEGER) AS CustomerID
FROM bronze_invoice_header""",
    "current_by_key": oracle_cte("bronze_invoice_header") + """
SELECT "partition", inv_num, cust_num, RecordDate, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY inv_num ORDER BY RecordDate DESC, "partition" DESC, seq DESC) AS rn
  FROM bronze_invoice_header) x WHERE rn = 1""",
    "source_count": oracle_cte("invoice_item") + "SELECT CAST(count(*) AS BIGINT) AS row_count FROM invoice_item",
    "sync_latest": oracle_cte("sync_log") + """
SELECT table_name, last_sync_at, run_id, rows_synced, sync_type FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY last_sync_at DESC, run_id DESC) AS rn
  FROM sync_log) x WHERE rn = 1""",
    "sync_summary": oracle_cte("sync_log") + SYNC_SUMMARY_BODY,
    "stale_syncs": oracle_cte("sync_log") + STALE_BODY,
    "bronze_audit": ctes(["sync_log", "bronze_invoice_header", "bronze_lineage"], {
        "expected": "SELECT DISTINCT table_name, concat(substr(CAST(last_sync_at AS VARCHAR), 1, 7), '-01-00') "
                    "AS \"partition\" FROM sync_log",
        "counts": "SELECT 'invoice_header' AS table_name, \"partition\", count(*) AS record_count "
                  "FROM bronze_invoice_header GROUP BY \"partition\"",
        "lin": "SELECT DISTINCT dataset AS table_name, \"partition\" FROM bronze_lineage"}) + """
SELECT e.table_name AS "table", e."partition",
       CASE WHEN c.record_count IS NULL THEN 'MISSING' WHEN c.record_count = 0 THEN 'EMPTY' ELSE 'OK' END AS status,
       CAST(COALESCE(c.record_count, 0) AS BIGINT) AS record_count,
       CASE WHEN c.record_count IS NOT NULL THEN l.table_name IS NULL END AS metadata_missing
FROM expected e
LEFT JOIN counts c ON e.table_name = c.table_name AND e."partition" = c."partition"
LEFT JOIN lin l ON e.table_name = l.table_name AND e."partition" = l."partition"
""",
    "quality_minima": oracle_cte("sales") + "SELECT min(quantity) AS min_quantity, min(unit_price) AS min_unit_price FROM sales",
    "view_typed_ids": f"""
SELECT Account, CAST(Transaction_Date AS DATE) AS Transaction_Date, Domestic_Amount, Foreign_Amount,
       FromID, Reference, RebateCustomerName,
       TRY_CAST(TRY_CAST(NULLIF(trim(txt), '') AS DECIMAL(10,0)) AS INTEGER) AS RebateCustomerID
FROM (SELECT *, COALESCE(CAST(RebateCustomerID AS VARCHAR) || '.0', '') AS txt FROM ({FACT_GENERAL_LEDGER}) f) g""",
    "sales_rollup": f"""
SELECT * FROM (
  SELECT CASE WHEN GROUPING(region) = 0 THEN 'region' WHEN GROUPING(product) = 0 THEN 'product' ELSE 'total' END
             AS "grouping",
         CASE WHEN GROUPING(region) = 0 THEN region WHEN GROUPING(product) = 0 THEN product END AS "key",
         CAST(COUNT(order_id) AS BIGINT) AS order_count,
         CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
         CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue,
         CAST(COUNT(*) AS BIGINT) AS total_orders,
         CAST(ROUND(AVG(total_amount), 4) AS DECIMAL(18,4)) AS avg_order_value
  FROM ({SILVER_SALES}) s GROUP BY GROUPING SETS ((region), (product), ())) x
WHERE "grouping" = 'total' OR "key" IS NOT NULL""",
}


ORACLE: dict[str, str] = {
    "margin_invoice": MARGIN_INVOICE,
    "fact_invoice": FACT_INVOICE,
    "fact_invoice_detail": FACT_INVOICE_DETAIL,
    "fact_order_item": FACT_ORDER_ITEM,
    "dim_customer": DIM_CUSTOMER,
    "fact_general_ledger": FACT_GENERAL_LEDGER,
    "margin_rebate": MARGIN_REBATE,
    "silver_sales": SILVER_SALES,
    "sales_by_region": _sales_by("region"),
    "sales_by_product": _sales_by("product"),
    "daily_summary": DAILY_SUMMARY,
    "daily_summary_by_region": _breakdown("region"),
    "daily_summary_by_product": _breakdown("product"),
}
ORACLE.update(NEW)

ORACLE["stream_sales_by_region"] = f"""
SELECT concat(strftime(order_date, '%Y'), '-01-01-00') AS "partition", region,
       CAST(COUNT(order_id) AS BIGINT) AS order_count,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
       CAST(COALESCE(SUM(total_amount), 0) AS DECIMAL(28,2)) AS total_revenue,
       DATE '{FIXED_REPORT_DATE}' AS report_date
FROM ({SILVER_SALES}) s WHERE region IS NOT NULL GROUP BY 1, 2"""

ORACLE["verification_report"] = oracle_cte("sync_log").rstrip() + f"""
, latest AS (SELECT table_name, last_sync_at, rows_synced, sync_type FROM (
      SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY last_sync_at DESC, run_id DESC) AS rn
      FROM sync_log) x WHERE rn = 1),
  summary AS ({SYNC_SUMMARY_BODY}),
  stale AS ({STALE_BODY})
SELECT 'sync_summary' AS section, CAST(NULL AS VARCHAR) AS "table", m.metric, m.value FROM summary,
  (VALUES ('total_tables', CAST(total_tables AS VARCHAR)), ('total_rows_synced', CAST(total_rows_synced AS VARCHAR)),
          ('oldest_sync', CAST(oldest_sync AS VARCHAR)), ('newest_sync', CAST(newest_sync AS VARCHAR))) m(metric, value)
UNION ALL
SELECT 'stale', "table", m.metric, m.value FROM stale,
  (VALUES ('last_sync', CAST(last_sync AS VARCHAR)), ('hours_ago', CAST(hours_ago AS VARCHAR)),
          ('reason', reason)) m(metric, value)
UNION ALL
SELECT 'table_state', table_name, m.metric, m.value FROM latest,
  (VALUES ('last_sync_at', CAST(last_sync_at AS VARCHAR)), ('rows_synced', CAST(rows_synced AS VARCHAR)),
          ('sync_type', sync_type)) m(metric, value)"""


# ---- the lake end to end ---------------------------------------------------------------------
ORACLE["source_sample"] = oracle_cte("invoice_header") + "SELECT * FROM invoice_header ORDER BY inv_num LIMIT 5"
ORACLE["ingest_roundtrip_incremental"] = oracle_cte("invoice_header") + "SELECT * FROM invoice_header"
ORACLE["ingest_two_date_partitions"] = oracle_cte("sales") + """
SELECT * FROM sales WHERE order_date IN (DATE '1996-01-02', DATE '1996-01-03')"""
ORACLE["gold_rebuild_empty"] = f"SELECT * FROM ({MARGIN_REBATE}) r WHERE false"
ORACLE["gold_latest_after_rerun"] = FACT_INVOICE_DETAIL
ORACLE["gold_current_from_lake"] = FACT_ORDER_ITEM
# Lines loaded up to each cut and then all: a line stays unless a later load has lines of its whole key.
CURRENT_ITEM = f"""
SELECT * EXCLUDE (load, newest) FROM (
  SELECT *, max(load) OVER (PARTITION BY inv_num, inv_line, co_line) AS newest FROM (
    SELECT *, CASE WHEN RecordDate <= TIMESTAMP '{FIXED_CUTS[0]}' THEN 0 WHEN RecordDate <= TIMESTAMP '{FIXED_CUTS[1]}'
                   THEN 1 ELSE 2 END AS load FROM versioned_item) v) w
WHERE load = newest OR inv_num IS NULL OR inv_line IS NULL OR co_line IS NULL"""
ORACLE["current_lines_from_lake"] = ctes(["versioned_item"]) + CURRENT_ITEM
ORACLE["gold_margin_from_lake"] = ctes(["versioned_item", "invoice_header", "order_item", "customer_address"],
                                       {"invoice_item": CURRENT_ITEM}) + MARGIN_BODY
# The second landing replaces a year unless its least quantity or price is not positive (or there is none).
ORACLE["silver_gate"] = ctes(["sales", "faulty_sales"]) + """
, v AS (SELECT concat(year(order_date), '-01-01-00') AS part, count(*) AS rows, min(quantity) AS min_quantity,
               min(unit_price) AS min_unit_price, sum(quantity) AS quantity,
               coalesce(min(quantity) > 0 AND min(unit_price) > 0, false) AS passed FROM faulty_sales GROUP BY 1),
  f AS (SELECT concat(year(order_date), '-01-01-00') AS part, count(*) AS rows, sum(quantity) AS quantity
        FROM sales GROUP BY 1)
SELECT part AS "partition", v.rows, min_quantity, min_unit_price, passed, f.rows AS silver_rows,
       CAST(CASE WHEN passed THEN v.quantity ELSE f.quantity END AS BIGINT) AS silver_quantity
FROM v JOIN f USING (part)"""
ORACLE["landing_lineage"] = ctes(["sales"]) + """
SELECT 'bronze' AS target_layer, 'sales' AS dataset, concat(strftime(order_date, '%Y-%m'), '-01-00') AS "partition",
       count(*) AS record_count, 'erp_system' AS source FROM sales GROUP BY 3"""
ORACLE["stream_reland"] = ORACLE["stream_after_batch"] = ORACLE["stream_sales_by_region"]

_LOG = """SELECT *, CASE WHEN run_id % 1000 = 0 THEN 'reset' ELSE 'ok' END AS status,
       CASE WHEN run_id % 3 > 0 THEN last_sync_at END AS last_sync_value,
       CASE WHEN run_id % 7 = 0 THEN 'full' ELSE 'incremental' END AS mode,
       strftime(last_sync_at, '%Y-%m-%d') || '-00' AS part FROM sync_log"""
ORACLE["sync_state_from_snapshot"] = ctes(["sync_log"], {"log": _LOG, "ranked": """
SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY last_sync_at DESC, run_id DESC) AS rn FROM log""", "resets": """
SELECT table_name, min(rn) AS reset_rn FROM ranked WHERE status = 'reset' GROUP BY table_name""", "since": """
SELECT r.* FROM ranked r LEFT JOIN resets USING (table_name) WHERE reset_rn IS NULL OR rn < reset_rn""", "totals": """
SELECT table_name, sum(rows_synced) AS total, arg_min(last_sync_value, rn) FILTER (last_sync_value IS NOT NULL) AS mark
FROM since GROUP BY table_name"""}) + """
SELECT r.table_name, CAST(r.run_id AS VARCHAR) AS run_id, r.status, r.rows_synced,
       CAST(CASE WHEN r.status = 'reset' THEN 0 ELSE coalesce(total, 0) END AS BIGINT) AS total_rows_synced,
       CASE WHEN r.status <> 'reset' THEN mark END AS last_sync_value,
       CASE WHEN p.status <> 'reset' THEN p.last_sync_at END AS previous_sync_at
FROM ranked r LEFT JOIN totals USING (table_name) LEFT JOIN ranked p ON p.table_name = r.table_name AND p.rn = 2
WHERE r.rn = 1"""
ORACLE["live_batches_from_snapshot"] = ctes(["sync_log"], {"log": _LOG, "fulls": """
SELECT table_name, part, max((last_sync_at, CAST(run_id AS VARCHAR))) AS newest FROM log
WHERE status = 'ok' AND mode = 'full' GROUP BY ALL"""}) + """
SELECT table_name, CAST(run_id AS VARCHAR) AS batch_id, part AS "partition", mode
FROM log LEFT JOIN fulls USING (table_name, part)
WHERE status = 'ok' AND (newest IS NULL OR (last_sync_at, CAST(run_id AS VARCHAR)) >= newest)"""

_BY_YEAR = """SELECT *, concat(strftime(order_date, '%Y'), '-01-01-00') AS part FROM silver"""
_CELLS = """SELECT part, 'by_region' AS section, region AS k, total_amount AS v FROM yearly WHERE region IS NOT NULL
UNION ALL SELECT part, 'by_product', product, total_amount FROM yearly WHERE product IS NOT NULL"""
_SUMS = "SELECT part, section, k, CAST(COALESCE(SUM(v), 0) AS DECIMAL(28,2)) AS v FROM cells GROUP BY ALL"
_SUMMARY = f"WITH silver AS ({SILVER_SALES}), yearly AS ({_BY_YEAR}), cells AS ({_CELLS}), sums AS ({_SUMS})"
ORACLE["summary_breakdowns"] = _SUMMARY + """
SELECT part AS "partition", section, k AS "key", v AS total_revenue FROM sums"""
ORACLE["summary_index"] = _SUMMARY + f"""
, maps AS (SELECT part, section, count(*) AS n, string_agg(k || '=' || CAST(v AS VARCHAR), ';' ORDER BY k) AS spelled
           FROM sums GROUP BY ALL)
SELECT y.part AS "partition", DATE '{FIXED_REPORT_DATE}' AS report_date, y.total_orders, y.total_revenue,
       y.avg_order_value, r.spelled AS by_region, p.spelled AS by_product, r.n AS by_region_keys, p.n AS by_product_keys
FROM (SELECT part, count(*) AS total_orders, CAST(SUM(total_amount) AS DECIMAL(28,2)) AS total_revenue,
             CAST(ROUND(AVG(total_amount), 4) AS DECIMAL(18,4)) AS avg_order_value FROM yearly GROUP BY part) y
JOIN maps r ON r.part = y.part AND r.section = 'by_region' JOIN maps p ON p.part = y.part AND p.section = 'by_product'"""

ORACLE["json_array_scan"] = oracle_cte("invoice_header") + "SELECT * FROM invoice_header"
ORACLE["csv_scan"] = oracle_cte("sales") + """
SELECT order_id, CASE WHEN order_id % 9 > 0 THEN customer_id ELSE '' END AS customer_id, product, quantity, unit_price,
       order_date, region, concat(strftime(order_date, '%Y'), '-01-01-00') AS "partition"
FROM sales WHERE year(order_date) IN (1996, 2000)"""
_LOADED = """SELECT 'invoice_item' AS t, 'incremental' AS kind, count(*) AS n FROM invoice_item
UNION ALL SELECT 'invoice_header', 'incremental', count(*) FROM invoice_header
UNION ALL SELECT 'order_item', 'incremental', count(*) FROM order_item
UNION ALL SELECT 'customer_address', 'full', count(*) FROM customer_address
UNION ALL SELECT 'general_ledger', 'full', count(*) FROM general_ledger WHERE acct = '422200'"""
ORACLE["ingest_run"] = ctes(["invoice_item", "invoice_header", "order_item", "customer_address", "general_ledger"],
                            {"loaded": _LOADED}) + """
SELECT 10 AS hour, t AS "table", 'full' AS mode, n AS rows_synced, false AS skipped, CAST(NULL AS VARCHAR) AS error FROM loaded
UNION ALL
SELECT 11, t, kind, CASE kind WHEN 'full' THEN n ELSE 0 END, kind <> 'full', NULL FROM loaded"""
ORACLE["gold_run"] = ctes(["invoice_item", "invoice_header", "order_item", "customer_address", "general_ledger"],
                          {"loaded": _LOADED}) + f"""
, hours(t, hour) AS (VALUES ('invoice_item', '05'), ('invoice_header', '04'), ('order_item', '03'), ('customer_address', '02'))
SELECT 'bronze' AS target_layer, t AS dataset, '2001-09-01-' || hour AS "partition", n AS record_count,
       CAST(NULL AS VARCHAR) AS source_tables FROM loaded JOIN hours USING (t)
UNION ALL SELECT 'gold', 'margin_invoice', '2001-09-01-05', (SELECT count(*) FROM ({MARGIN_BODY}) m),
       'invoice_item,invoice_header,order_item,customer_address'
UNION ALL SELECT 'gold', 'fact_order_item', '2001-09-01-03', (SELECT n FROM loaded WHERE t = 'order_item'), 'order_item'
UNION ALL SELECT 'gold', 'dim_customer', '2001-09-01-02', (SELECT n FROM loaded WHERE t = 'customer_address'),
       'customer_address'"""
ORACLE["margin_without_order_keys"] = ctes(["invoice_item", "invoice_header", "customer_address"]) + f"""
SELECT trim(i.inv_num) AS Invoice, CAST({_case_map('h.cust_num', CUSTOMER_ID_MAPPING)} AS INTEGER) AS CustomerID,
       {_case_map('a.name', CUSTOMER_NAME_MAPPING)} AS CustomerName, CAST({TS.format('i.tax_date')} AS DATE) AS InvoiceDate,
       CAST(NULL AS VARCHAR) AS ProductID, CAST(NULL AS VARCHAR) AS ProductName,
       {_measures('i.qty_invoiced', 'i.price', 'i.cost')}
FROM invoice_item i LEFT JOIN invoice_header h ON i.inv_num = h.inv_num
LEFT JOIN (SELECT cust_num, name FROM customer_address WHERE cust_seq = 0) a ON h.cust_num = a.cust_num"""
ORACLE["serving_views"] = f"""
WITH n AS (SELECT (SELECT count(*) FROM ({DIM_CUSTOMER}) d) AS customers, (SELECT count(*) FROM ({MARGIN_REBATE}) m) AS rebates)
SELECT 'dim_customer' AS "view", 'created' AS status, customers AS rows, least(3, customers) AS sample_rows FROM n
UNION ALL SELECT 'margin_rebate', 'created', rebates, least(3, rebates) FROM n
UNION ALL SELECT 'sales_by_region', 'skipped', NULL, NULL UNION ALL SELECT 'no_such_view', 'error', NULL, NULL"""

# ---- coercions on hard inputs ------------------------------------------------------------------
ORACLE["date_layouts"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 19 <> 7 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders"""
_LARGE = "CAST({} * {} AS DECIMAL(33,4))"  # whole numbers, multiplied as HUGEINT
ORACLE["large_measures"] = f"""
SELECT concat('INV', CAST(o AS VARCHAR)) AS InvoiceID, TIMESTAMP '1999-01-01 00:00:00' AS InvoiceDate,
       CAST(q AS DECIMAL(18,4)) AS QtyInvoiced, {_LARGE.format('q', 'p')} AS ExtendedPrice,
       {_LARGE.format('q', '(-p)')} AS TotalCost, {_LARGE.format('q', '(2 * p)')} AS Margin
FROM (SELECT l_orderkey AS o, CAST(90000000000000 - CAST(l_quantity AS INTEGER) AS HUGEINT) AS q,
             CAST(90000000000000 - l_orderkey AS HUGEINT) AS p FROM lineitem) x"""

# ---- typed serving views: the dataset's columns in the view's types --------------------------------
_VIEW_TYPES = {
    "fact_invoice": "InvoiceID, CAST(InvoiceDate AS DATE) AS InvoiceDate, QtyInvoiced, ExtendedPrice, TotalCost, Margin",
    "fact_invoice_detail": "*", "fact_order_item": "*", "dim_customer": "*", "margin_invoice": "*",
    "margin_rebate": "RebateCustomerName, RebateCustomerID, CAST(Domestic_Amount AS DECIMAL(18,4)) AS Domestic_Amount",
    "sales_by_region": "* REPLACE (CAST(report_date AS VARCHAR) AS report_date)",
    "sales_by_product": "* REPLACE (CAST(report_date AS VARCHAR) AS report_date)",
    "silver_sales": "* REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(order_date AS VARCHAR) AS order_date, "
                    "CAST(processed_at AS VARCHAR) AS processed_at)",
}
ORACLE.update({f"view_{name}": f"SELECT {columns} FROM ({ORACLE[name]}) v" for name, columns in _VIEW_TYPES.items()})
