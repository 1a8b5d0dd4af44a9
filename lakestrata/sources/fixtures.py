"""Bronze-shaped inputs derived from the raw test tables (see FIXTURES.md).

The same SQL text runs in Spark (as temp views over the parquet tables) and in DuckDB
(as CTEs in the oracle queries), so both engines start from identical inputs. The
derivations inject the hard cases deliberately (bad numbers, mixed dates, padded ids,
missing headers / order lines / addresses, mapped and null names, rebate references);
they transform whole tables, nothing is sampled.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# {q} is the identifier quote of the engine: backquote in Spark, double quote in DuckDB.
FIXTURE_SQL: dict[str, str] = {
    "invoice_item": """
SELECT concat('  INV', CAST(l_orderkey AS STRING), ' ') AS inv_num,
       l_linenumber AS inv_line,
       concat('CO', CAST(l_orderkey AS STRING)) AS co_num,
       l_linenumber AS co_line,
       concat('P', CAST(l_partkey AS STRING)) AS item,
       CASE WHEN (l_orderkey + l_partkey) % 101 = 0 THEN 'not-a-date'
            WHEN l_partkey % 3 = 0 THEN substr(CAST(l_shipdate AS STRING), 1, 10)
            WHEN l_partkey % 3 = 1 THEN concat(substr(CAST(l_shipdate AS STRING), 1, 10), ' 10:30:00')
            ELSE concat(substr(CAST(l_shipdate AS STRING), 1, 10), ' 10:30:00.123456') END AS tax_date,
       CASE WHEN (l_orderkey + l_partkey) % 97 = 0 THEN 'n/a'
            WHEN (l_orderkey + l_partkey) % 89 = 0 THEN NULL
            ELSE CAST(CAST(l_quantity AS DECIMAL(18,4)) AS STRING) END AS qty_invoiced,
       CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS STRING) AS price,
       CAST(CAST(p_retailprice * 0.7 AS DECIMAL(18,4)) AS STRING) AS cost,
       l_shipdate AS RecordDate
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "invoice_header": """
SELECT concat('  INV', CAST(o_orderkey AS STRING), ' ') AS inv_num,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS INT) END AS cust_num,
       o_orderdate AS RecordDate
FROM orders WHERE o_orderkey % 41 <> 0""",
    "order_item": """
SELECT concat('CO', CAST(l_orderkey AS STRING)) AS co_num,
       l_linenumber AS co_line,
       min(concat('P', CAST(l_partkey AS STRING))) AS item,
       CAST(CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS STRING) AS qty_ordered,
       CASE WHEN l_orderkey % 13 = 0 THEN 'pending'
            ELSE CAST(CAST(min(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS STRING) END AS qty_shipped,
       CAST(CAST(min(p_retailprice) * 0.7 AS DECIMAL(18,4)) AS STRING) AS cost,
       CAST(CAST(min(p_retailprice) AS DECIMAL(18,4)) AS STRING) AS price,
       min(p_name) AS description,
       max(l_shipdate) AS RecordDate
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_orderkey % 37 <> 0
GROUP BY l_orderkey, l_linenumber""",
    "customer_address": """
SELECT CAST(c_custkey AS INT) AS cust_num, 0 AS cust_seq,
       CASE c_custkey % 12
            WHEN 0 THEN 'CVS CAREMARK' WHEN 1 THEN 'OMNICARE' WHEN 2 THEN 'Owens & Minor'
            WHEN 3 THEN 'O&M Main Street' WHEN 4 THEN 'Kaleida Health'
            WHEN 5 THEN 'Methodist Le Bonheur Healthcare'
            WHEN 6 THEN 'METHODIST HOSPITAL WESTOVER HILLS / San Antonio Supply Chain'
            WHEN 7 THEN NULL WHEN 8 THEN 'omnicare' ELSE c_name END AS name
FROM customer WHERE c_custkey % 29 <> 0
UNION ALL
SELECT CAST(c_custkey AS INT), 1, 'SHIP-TO' FROM customer WHERE c_custkey % 3 = 0""",
    "general_ledger": """
SELECT o_orderkey AS trans_num,
       CASE o_orderkey % 4 WHEN 0 THEN '410000' WHEN 1 THEN NULL ELSE '422200' END AS acct,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_orderdate AS STRING) END AS trans_date,
       CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS STRING) AS dom_amount,
       CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS STRING) END AS for_amount,
       concat('SRC', CAST(o_orderkey % 5 AS STRING)) AS from_id,
       CASE o_orderkey % 13
            WHEN 0 THEN 'Mckesson Q1 rebate' WHEN 1 THEN 'Cardinal rebate' WHEN 2 THEN 'Retro adj'
            WHEN 3 THEN 'Owens/Retro Rebate FY 2025' WHEN 4 THEN 'Medline' WHEN 5 THEN NULL
            WHEN 6 THEN ' lead space' WHEN 7 THEN 'Zed unmapped' WHEN 8 THEN 'Income misc'
            WHEN 9 THEN 'Owens Q2' WHEN 10 THEN 'Schein x' WHEN 11 THEN 'Seneca y' ELSE '' END AS ref
FROM orders""",
    "sales": """
SELECT l_orderkey AS order_id, concat('C', CAST(o_custkey AS STRING)) AS customer_id, p_brand AS product,
       CAST(l_quantity AS INT) AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       CAST(l_shipdate AS DATE) AS order_date, r_name AS region
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey""",
    # One date in the layouts a source may send: ISO, month first, year first, month names, with times.
    "dated_text": """
SELECT o_orderkey AS id, CASE o_orderkey % 19
         WHEN 0 THEN concat(y, '-', mm, '-', dd) WHEN 1 THEN concat(m, '/', d, '/', y)
         WHEN 2 THEN concat(m, '/', d, '/', y, ' 10:30') WHEN 3 THEN concat(y, '/', mm, '/', dd)
         WHEN 4 THEN concat(mon, ' ', d, ', ', y) WHEN 5 THEN concat(mon, '  ', d, ' ', y, ' 10:30AM')
         WHEN 6 THEN concat(y, mm, dd) WHEN 7 THEN '10:30' WHEN 8 THEN concat(m, '/', d, '/', y, ' 10:30 AM')
         WHEN 9 THEN concat(m, '/', d, '/', y, ' 11:59:59 PM') WHEN 10 THEN concat(dd, '-', mon, '-', y)
         WHEN 11 THEN concat(d, ' ', mon, ' ', y) WHEN 12 THEN concat(m, '/', d, '/', substr(y, 3, 2))
         WHEN 13 THEN concat(y, mm, dd, 'T235959') WHEN 14 THEN concat(m, '-', d, '-', y)
         WHEN 15 THEN concat(y, '.', mm, '.', dd)
         WHEN 16 THEN CASE WHEN CAST(d AS INT) > 12 THEN concat(d, '/', m, '/', y) ELSE concat(m, '/', d, '/', y) END
         WHEN 17 THEN concat(y, '-', mm, '-', dd, 'T23:30:00+02:00')
         ELSE concat(month_name, ' ', d, ', ', y, ' 12:00 AM') END AS text
FROM (SELECT o_orderkey, substr(t, 1, 4) AS y, substr(t, 6, 2) AS mm, substr(t, 9, 2) AS dd,
             CAST(CAST(substr(t, 6, 2) AS INT) AS STRING) AS m, CAST(CAST(substr(t, 9, 2) AS INT) AS STRING) AS d,
             substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr(t, 6, 2) AS INT) - 2, 3) AS mon,
             CASE substr(t, 6, 2) WHEN '01' THEN 'January' WHEN '02' THEN 'February' WHEN '03' THEN 'March'
                  WHEN '04' THEN 'April' WHEN '05' THEN 'may' WHEN '06' THEN 'JUNE' WHEN '07' THEN 'July'
                  WHEN '08' THEN 'August' WHEN '09' THEN 'September' WHEN '10' THEN 'October'
                  WHEN '11' THEN 'November' ELSE 'December' END AS month_name
      FROM (SELECT o_orderkey, CAST(o_orderdate AS STRING) AS t FROM orders) a) b""",
    # Invoice lines whose quantities and prices are near the top of DECIMAL(18,4).
    "large_item": """
SELECT concat('INV', CAST(l_orderkey AS STRING)) AS inv_num, l_linenumber AS inv_line, '1999-01-01' AS tax_date,
       CAST(90000000000000 - CAST(l_quantity AS INT) AS STRING) AS qty_invoiced,
       CAST(90000000000000 - l_orderkey AS STRING) AS price, CAST(l_orderkey - 90000000000000 AS STRING) AS cost
FROM lineitem""",
    # Monthly bronze partitions of invoice headers; inv_num repeats across months so that
    # 'latest', 'all' and 'current' scopes differ. seq breaks timestamp ties.
    "bronze_invoice_header": """
SELECT concat(substr(CAST(o_orderdate AS STRING), 1, 7), '-01-00') AS {q}partition{q},
       concat('  INV', CAST(o_orderkey % 500 AS STRING), ' ') AS inv_num,
       CAST(o_custkey AS INT) AS cust_num, o_orderdate AS RecordDate, o_orderkey AS seq
FROM orders""",
    # One row per finished ingestion run.
    "sync_log": """
SELECT CASE o_orderkey % 5 WHEN 0 THEN 'invoice_item' WHEN 1 THEN 'invoice_header' WHEN 2 THEN 'order_item'
            WHEN 3 THEN 'customer_address' ELSE 'general_ledger' END AS table_name,
       o_orderdate AS last_sync_at, o_orderkey AS run_id, o_orderkey % 1000 AS rows_synced,
       CASE WHEN o_orderkey % 5 < 3 THEN 'incremental' ELSE 'full_refresh' END AS sync_type
FROM orders""",
    # Lineage records of the bronze invoice-header partitions; July partitions lack one.
    "bronze_lineage": """
SELECT DISTINCT 'invoice_header' AS dataset, {q}partition{q}
FROM (SELECT concat(substr(CAST(o_orderdate AS STRING), 1, 7), '-01-00') AS {q}partition{q} FROM orders) months
WHERE substr({q}partition{q}, 6, 2) <> '07'""",
}

# Invoice lines as versions arrive: keys repeat, and a third of the lines has none.
FIXTURE_SQL["versioned_item"] = f"""
SELECT inv_num, CASE WHEN inv_line % 3 = 0 THEN NULL ELSE inv_line END AS inv_line, co_num, co_line, item, tax_date,
       qty_invoiced, price, cost, RecordDate
FROM ({FIXTURE_SQL['invoice_item']}) x"""

# The same sales landed again with corrected quantities; two years fail the gate (a negative quantity, no price).
FIXTURE_SQL["faulty_sales"] = f"""
SELECT order_id, customer_id, product,
       CASE WHEN year(order_date) = 1997 AND order_id % 10 = 7 THEN -1 ELSE quantity + 1 END AS quantity,
       CASE WHEN year(order_date) = 1999 THEN NULL ELSE unit_price END AS unit_price, order_date, region
FROM ({FIXTURE_SQL['sales']}) x"""

# Run parameters fixed for reproducible checks (wall-clock stand-ins).
FIXED_NOW = "2001-09-01 00:00:00"
FIXED_AS_OF = "1999-06-01"
FIXED_REPORT_DATE = "2001-09-01"
FIXED_PARTITION = "2001-09-01-00"
#: RecordDates that end a full load and the first of two deltas after it.
FIXED_CUTS = ("2000-06-30 00:00:00", "2001-09-30 00:00:00")


def fixture_sql(name: str, engine: str = "spark") -> str:
    return FIXTURE_SQL[name].format(q="`" if engine == "spark" else '"')


MIN_BALANCE_BYTES = 4 << 20


def balance_splits(df: DataFrame, min_bytes: int = MIN_BALANCE_BYTES) -> DataFrame:
    """Spread an under-split scan over all cores.

    A Parquet file splits only at row-group boundaries, so a large single-row-group file
    is read (and everything before the first shuffle computed) by one task. When a scan
    of at least ``min_bytes`` has fewer splits than the default parallelism, a
    round-robin repartition (placed after column pruning by the optimizer) fixes that.
    Inputs made of many files / row groups already have enough splits and are untouched.
    """
    try:
        spark = df.sparkSession
        sc = spark.sparkContext
        parallelism = sc.defaultParallelism
        if df.rdd.getNumPartitions() >= parallelism:
            return df
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
        size = 0
        for f in df.inputFiles():
            p = jvm.org.apache.hadoop.fs.Path(f)
            size += p.getFileSystem(conf).getFileStatus(p).getLen()
    except Exception:  # noqa: BLE001 - no classic SparkContext (e.g. Spark Connect): leave as is
        return df
    return df.repartition(parallelism) if size >= min_bytes else df


_registered: set[tuple[int, str]] = set()
_FROM_TABLE = re.compile(r"\b(FROM|JOIN)(\s+)(" + "|".join(RAW_TABLES) + r")\b")


def view_name(table: str, sf_dir: str) -> str:
    """Session view name of a raw table of one data directory (no clash with user views)."""
    return f"{table}__{hashlib.sha1(sf_dir.rstrip('/').encode()).hexdigest()[:10]}"


def tables_used(sql: str) -> list[str]:
    return sorted({m.group(3) for m in _FROM_TABLE.finditer(sql)})


def register_raw(spark: SparkSession, sf_dir: str, tables=RAW_TABLES) -> None:
    """Temp views over the raw parquet tables of ``sf_dir`` (schema from footers; no data read).

    Registration is remembered per session, so repeated plans do not re-list files.
    """
    base = sf_dir.rstrip("/")
    for t in tables:
        name = view_name(t, base)
        if (id(spark), name) not in _registered or not spark.catalog.tableExists(name):
            balance_splits(spark.read.parquet(f"{base}/{t}.parquet")).createOrReplaceTempView(name)
            _registered.add((id(spark), name))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived fixture as a lazy DataFrame over the parquet tables in ``sf_dir``."""
    sql = fixture_sql(name, "spark")
    register_raw(spark, sf_dir, tables_used(sql))
    return spark.sql(_FROM_TABLE.sub(lambda m: m.group(1) + m.group(2) + view_name(m.group(3), sf_dir), sql))


def oracle_cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for DuckDB oracle queries."""
    return "WITH " + ",\n".join(f"{n} AS ({fixture_sql(n, 'duckdb')})" for n in names) + "\n"
