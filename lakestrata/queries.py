"""Registry of runnable queries: one per operator group of the survey inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole test
tables (or bronze fixtures Spark derives from them). Run parameters that stand for the
wall clock (``now``, ``as_of``, report date) are fixed so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators import facts, latest, ledger, margin, quality, sales
from lakestrata.functions.coerce import parse_timestamp
from lakestrata.plans import gold, ingest, summary, synclog
from lakestrata.plans.lake import (
    Lake, append_ops, read_csv_layer, read_json_array, read_layer, read_lineage, write_gold,
)
from lakestrata.plans.sales_flow import gate_partitions, run_sales_flow, write_bronze_sales
from lakestrata.plans.views import VIEWS, create_views, sample_views, typed_view_frame
from lakestrata.session import configure, shared_dir
from lakestrata.sources.fixtures import (
    FIXED_AS_OF, FIXED_CUTS, FIXED_NOW, FIXED_PARTITION, FIXED_REPORT_DATE, load,
)
from lakestrata.sources.jdbc import count_rows
from lakestrata.specs import CLIENT_TABLES, Pattern, TableSpec, incremental_tables, spec
from lakestrata.streaming.sales_stream import run_available_now

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return load(spark, sf_dir, name)


def q_margin_invoice(spark, sf_dir):
    return margin.margin_invoice(_fx(spark, sf_dir, "invoice_item"), _fx(spark, sf_dir, "invoice_header"),
                                 _fx(spark, sf_dir, "order_item"), _fx(spark, sf_dir, "customer_address"))


def q_fact_invoice(spark, sf_dir):
    return facts.fact_invoice(_fx(spark, sf_dir, "invoice_item"))


def q_fact_invoice_detail(spark, sf_dir):
    return facts.fact_invoice_detail(_fx(spark, sf_dir, "invoice_header"))


def q_fact_order_item(spark, sf_dir):
    return facts.fact_order_item(_fx(spark, sf_dir, "order_item"))


def q_dim_customer(spark, sf_dir):
    return facts.dim_customer(_fx(spark, sf_dir, "customer_address"))


def q_fact_general_ledger(spark, sf_dir):
    return ledger.fact_general_ledger(_fx(spark, sf_dir, "general_ledger"), as_of=FIXED_AS_OF)


def q_margin_rebate(spark, sf_dir):
    return ledger.margin_rebate(q_fact_general_ledger(spark, sf_dir))


def q_silver_sales(spark, sf_dir):
    return sales.enrich_sales(_fx(spark, sf_dir, "sales"), now=FIXED_NOW)


def q_sales_by_region(spark, sf_dir):
    return sales.sales_by_region(q_silver_sales(spark, sf_dir), FIXED_REPORT_DATE)


def q_sales_by_product(spark, sf_dir):
    return sales.sales_by_product(q_silver_sales(spark, sf_dir), FIXED_REPORT_DATE)


def q_daily_summary(spark, sf_dir):
    return sales.summary_totals(q_silver_sales(spark, sf_dir), FIXED_REPORT_DATE, FIXED_PARTITION)


def q_daily_summary_by_region(spark, sf_dir):
    return sales.summary_breakdown(q_silver_sales(spark, sf_dir), "region")


def q_daily_summary_by_product(spark, sf_dir):
    return sales.summary_breakdown(q_silver_sales(spark, sf_dir), "product")


# ---- ingestion (S1-S4, F1, O1, A6, D4) --------------------------------------------------

SALES_BY_DAY = TableSpec("sales_mst", "sales", Pattern.DATE_PARTITION, partition_column="order_date",
                         keys=("order_id",), domain="erp")
FIXED_LOAD_DATE = "1996-01-02"


def q_ingest_full_filtered(spark, sf_dir):
    df, _ = ingest.plan_load(spec("general_ledger"), _fx(spark, sf_dir, "general_ledger"))
    return df


def _fixture_state(spark, sf_dir, table: str) -> synclog.SyncState | None:
    """State of ``table`` from the fixture sync log (one row to the driver)."""
    row = (synclog.sync_latest(_fx(spark, sf_dir, "sync_log")).where(F.col("table_name") == table)
           .select("last_sync_at", "rows_synced").first())
    if row is None:
        return None
    return synclog.SyncState(table, "ok", row.last_sync_at, row.last_sync_at, int(row.rows_synced),
                             int(row.rows_synced))


def q_ingest_incremental(spark, sf_dir):
    state = _fixture_state(spark, sf_dir, "invoice_item")
    df, _ = ingest.plan_load(spec("invoice_item"), _fx(spark, sf_dir, "invoice_item"), state)
    return df


def q_ingest_date_partition(spark, sf_dir):
    df, _ = ingest.plan_load(SALES_BY_DAY, _fx(spark, sf_dir, "sales"), partition_value=FIXED_LOAD_DATE)
    return df


def q_incremental_watermark(spark, sf_dir):
    out = None
    for s in incremental_tables():
        w = ingest.batch_watermarks(_fx(spark, sf_dir, s.target_table), s.target_table, s.timestamp_column)
        out = w if out is None else out.unionByName(w)
    return out


# ---- partitions and versions (S11-S13, O2, U1, scope=current) -------------------------

def q_latest_partition_scan(spark, sf_dir):
    return latest.latest_partition_scan(_fx(spark, sf_dir, "bronze_invoice_header"))


def q_partition_list(spark, sf_dir):
    return latest.partition_list(_fx(spark, sf_dir, "bronze_invoice_header"), 10)


def q_gold_all_partitions(spark, sf_dir):
    """A fact over every partition of its source (wildcard read), partition kept."""
    b = _fx(spark, sf_dir, "bronze_invoice_header")
    return facts.fact_invoice_detail(b, keep=("partition",))


def q_current_by_key(spark, sf_dir):
    return latest.current_by_key(_fx(spark, sf_dir, "bronze_invoice_header"), ["inv_num"],
                                 ["RecordDate", "partition", "seq"])


# ---- sources (S7, S8) ------------------------------------------------------------------------

def q_source_count(spark, sf_dir):
    return count_rows(_fx(spark, sf_dir, "invoice_item"))


def q_source_sample(spark, sf_dir):
    return _fx(spark, sf_dir, "invoice_header").orderBy("inv_num").limit(5)


# ---- sync log and freshness (K7-K9, X3, X4, D5) --------------------------------------------

def q_sync_latest(spark, sf_dir):
    return synclog.sync_latest(_fx(spark, sf_dir, "sync_log"))


def q_sync_summary(spark, sf_dir):
    return synclog.sync_summary(_fx(spark, sf_dir, "sync_log"))


def _lake_log(spark, sf_dir) -> DataFrame:
    """The fixture's runs as the engine logs them; every thousandth is a reset."""
    log = _fx(spark, sf_dir, "sync_log")
    value = {"status": F.when(F.col("run_id") % 1000 == 0, "reset").otherwise("ok"),
             "last_sync_value": F.when(F.col("run_id") % 3 > 0, F.col("last_sync_at")),
             "mode": F.when(F.col("run_id") % 7 == 0, "full").otherwise("incremental"),
             "partition": F.concat(F.date_format("last_sync_at", "yyyy-MM-dd"), F.lit("-00"))}
    return log.select(*[(value[f.name] if f.name in value else F.col(f.name) if f.name in log.columns else F.lit(None))
                        .cast(f.dataType).alias(f.name) for f in schemas.SYNC_LOG.fields])


def q_sync_state_from_snapshot(spark, sf_dir):
    """States of a log whose closed months are folded, in two steps, and read from the snapshot on."""
    lake = _lake(spark, "sync-state")
    append_ops(_lake_log(spark, sf_dir), lake.sync_log, "last_sync_at")
    for month in ("1998-05", "2001-06"):
        ingest.snapshot_sync_log(spark, lake, month)
    return synclog.sync_states(synclog.read_log(spark, lake)).select(
        "table_name", "run_id", "status", "rows_synced", "total_rows_synced", "last_sync_value", "previous_sync_at")


def q_live_batches_from_snapshot(spark, sf_dir):
    """Batches that readers see, from the snapshot on."""
    lake = _lake(spark, "live")
    append_ops(_lake_log(spark, sf_dir), lake.sync_log, "last_sync_at")
    ingest.snapshot_sync_log(spark, lake, "2001-06")
    return ingest.live_runs(synclog.read_log(spark, lake)).select("table_name", "batch_id", "partition", "mode")


def q_stale_syncs(spark, sf_dir):
    return synclog.stale_syncs(_fx(spark, sf_dir, "sync_log"), [s.target_table for s in CLIENT_TABLES],
                               now=FIXED_NOW, max_age_hours=24)


# ---- checks (X1, X2, A7) -------------------------------------------------------------------

def q_bronze_audit(spark, sf_dir):
    log = _fx(spark, sf_dir, "sync_log")
    expected = log.select("table_name", F.concat(F.substring(F.col("last_sync_at").cast("string"), 1, 7),
                                                 F.lit("-01-00")).alias("partition"))
    bronze = _fx(spark, sf_dir, "bronze_invoice_header")
    counts = bronze.groupBy("partition").agg(F.count(F.lit(1)).alias("record_count")) \
        .withColumn("table_name", F.lit("invoice_header"))
    return quality.bronze_audit(expected, counts, _fx(spark, sf_dir, "bronze_lineage"))


def q_quality_minima(spark, sf_dir):
    return quality.quality_minima(q_silver_sales(spark, sf_dir), ["quantity", "unit_price"])


def q_verification_report(spark, sf_dir):
    log = _fx(spark, sf_dir, "sync_log")
    return quality.verification_report(
        synclog.sync_summary(log),
        synclog.stale_syncs(log, [s.target_table for s in CLIENT_TABLES], now=FIXED_NOW, max_age_hours=24),
        synclog.sync_latest(log).select("table_name", "last_sync_at", "rows_synced", "sync_type"))


# ---- serving views (C1, V6) ----------------------------------------------------------------

def q_view_typed_ids(spark, sf_dir):
    gl = q_fact_general_ledger(spark, sf_dir)
    # ids as a CSV round trip leaves them: float text, '' for missing
    as_text = gl.withColumn("RebateCustomerID", F.coalesce(
        F.concat(F.col("RebateCustomerID").cast("string"), F.lit(".0")), F.lit("")))
    return typed_view_frame(as_text, VIEWS["fact_general_ledger"][2])


# ---- one-pass sales gold (A1-A3 as grouping sets) ---------------------------------------------

def q_sales_rollup(spark, sf_dir):
    return sales.sales_rollup(q_silver_sales(spark, sf_dir))


# ---- arrival-driven sales flow (W1) ---------------------------------------------------------

def year_partition(date_col: str = "order_date"):
    return F.concat(F.date_format(F.col(date_col), "yyyy"), F.lit("-01-01-00"))


def q_stream_sales_by_region(spark, sf_dir):
    """Land the sales rows in bronze (yearly partitions), run the stream once, read its gold."""
    lake = Lake(shared_dir(spark, f"stream-sales-{uuid.uuid4().hex[:12]}"))
    write_bronze_sales(_fx(spark, sf_dir, "sales"), lake, partition_col=year_partition())
    run_available_now(spark, lake, report_date=FIXED_REPORT_DATE, now=FIXED_NOW)
    return _stream_gold(spark, lake)


# ---- the lake end to end: what readers see after loads, reruns and rebuilds (K1-K4, S2, S3, W1) ----

def _lake(spark, name: str) -> Lake:
    return Lake(shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}"))


def _stored(spark, lake: Lake, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a stored source table beside the lake, for runs that read it several times."""
    made = _fx(spark, sf_dir, name)
    path = f"{lake.root}/_source/{name}"
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _load_in_two(spark, lake: Lake, sf_dir: str, table: str) -> None:
    """A full load of the older part of a table, then an incremental load of all of it."""
    source = _stored(spark, lake, sf_dir, table)
    cut = source.agg(F.percentile_approx(F.unix_date(F.to_date("RecordDate")), 0.7).alias("d")).first().d
    for hour, df in (("00", source.where(F.unix_date(F.to_date("RecordDate")) <= cut)), ("01", source)):
        ingest.ingest_table(spark, spec(table), lake, f"2001-09-01-{hour}", lambda _, df=df: df)


def q_ingest_roundtrip_incremental(spark, sf_dir):
    """Every header is readable once after a full and an incremental load."""
    lake = _lake(spark, "roundtrip")
    _load_in_two(spark, lake, sf_dir, "invoice_header")
    return gold.read_bronze(spark, lake, "invoice_header", "current")[0].select("inv_num", "cust_num", "RecordDate")


def q_ingest_two_date_partitions(spark, sf_dir):
    """Two dates loaded in one hour, one of them twice: each is readable once."""
    lake, source = _lake(spark, "dates"), _fx(spark, sf_dir, "sales")
    for value in (FIXED_LOAD_DATE, "1996-01-03", FIXED_LOAD_DATE):
        ingest.ingest_table(spark, SALES_BY_DAY, lake, FIXED_PARTITION, lambda _: source, partition_value=value)
    return read_layer(spark, lake, "bronze", "sales", schemas.BRONZE["sales"],
                      committed_batches=ingest.committed_batches(spark, lake, "sales")).select(*source.columns)


def q_gold_rebuild_empty(spark, sf_dir):
    """A rebuild without eligible rows leaves none of the rows that the build before it wrote."""
    lake, rebate = _lake(spark, "rebuild"), q_margin_rebate(spark, sf_dir)
    for frame in (rebate, rebate.where(F.lit(False))):
        write_gold(frame, lake, "margin_rebate", FIXED_PARTITION, ["general_ledger"])
    return read_layer(spark, lake, "gold", "margin_rebate", schemas.GOLD["margin_rebate"]).drop("partition")


def q_gold_latest_after_rerun(spark, sf_dir):
    """An incremental rerun within the hour re-reads the boundary second; gold has every header once."""
    lake, source = _lake(spark, "rerun"), _fx(spark, sf_dir, "invoice_header")
    for _ in range(2):
        ingest.ingest_table(spark, spec("invoice_header"), lake, FIXED_PARTITION,
                            lambda _: source.withColumn("RecordDate", F.expr("RecordDate + INTERVAL 0.5 SECOND")))
    gold.build_gold(spark, lake, ["fact_invoice_detail"], scope="latest")
    return read_layer(spark, lake, "gold", "fact_invoice_detail", schemas.GOLD["fact_invoice_detail"]).drop("partition")


def q_gold_current_from_lake(spark, sf_dir):
    lake = _lake(spark, "current")
    _load_in_two(spark, lake, sf_dir, "order_item")
    gold.build_gold(spark, lake, ["fact_order_item"], scope="current")
    return read_layer(spark, lake, "gold", "fact_order_item", schemas.GOLD["fact_order_item"]).drop("partition")


def _load_step(spark, lake: Lake, source: DataFrame, table: str, step: int) -> None:
    """Load 0 is full and ends at the first cut; loads 1 and 2 are incremental, up to the second cut and all."""
    arrived = source if step == 2 else source.where(F.col("RecordDate") <= F.lit(FIXED_CUTS[step]).cast("timestamp_ntz"))
    ingest.ingest_table(spark, spec(table), lake, f"2001-09-01-0{step}", lambda _: arrived)


def q_current_lines_from_lake(spark, sf_dir):
    """Lines with repeated and null keys over three batches: every row of each key's newest batch."""
    lake = _lake(spark, "current-lines")
    source = _stored(spark, lake, sf_dir, "versioned_item")
    for step in range(3):
        _load_step(spark, lake, source, "invoice_item", step)
    return gold.read_bronze(spark, lake, "invoice_item", "current")[0].select(*schemas.BRONZE["invoice_item"].fieldNames())


def q_gold_margin_from_lake(spark, sf_dir):
    """The flagship in its default scope after a full load and two deltas of its sources; a build between
    the deltas leaves state that the last build only folds the second delta into."""
    lake = _lake(spark, "margin")
    source = {t: _stored(spark, lake, sf_dir, "versioned_item" if t == "invoice_item" else t)
              for t in gold.GOLD_SOURCES["margin_invoice"] if spec(t).pattern is Pattern.INCREMENTAL}
    for step in range(3):
        for table in gold.GOLD_SOURCES["margin_invoice"]:
            if table in source:
                _load_step(spark, lake, source[table], table, step)
            elif step == 0:
                ingest.ingest_table(spark, spec(table), lake, FIXED_PARTITION, lambda s: _fx(spark, sf_dir, s.target_table))
        if step:
            gold.build_gold(spark, lake, ["margin_invoice"])
    fields = schemas.with_fields(schemas.GOLD["margin_invoice"], ("partition", "string"))
    return read_layer(spark, lake, "gold", "margin_invoice", fields, "latest").drop("partition")


def q_silver_gate(spark, sf_dir):
    """The gate's verdict per partition after a second landing, and what silver holds then: a partition that
    failed still has the rows of the first."""
    lake = _lake(spark, "gate")
    for fixture in ("sales", "faulty_sales"):
        write_bronze_sales(_fx(spark, sf_dir, fixture), lake, partition_col=year_partition())
        bronze = read_layer(spark, lake, "bronze", "sales", schemas.BRONZE["sales"])
        verdict = gate_partitions(sales.enrich_sales(bronze, FIXED_NOW), lake, lake.checkpoints("verdict"))
    silver = read_layer(spark, lake, "silver", "sales", schemas.SILVER_SALES).groupBy("partition").agg(
        F.count(F.lit(1)).alias("silver_rows"), F.sum("quantity").alias("silver_quantity"))
    return verdict.join(silver, "partition", "left") \
        .select("partition", "rows", "min_quantity", "min_unit_price", F.col("good").alias("passed"), "silver_rows",
                "silver_quantity")


def q_landing_lineage(spark, sf_dir):
    """Lineage of a landing in many partitions, counted from the files it wrote."""
    lake = _lake(spark, "landing")
    monthly = F.concat(F.date_format("order_date", "yyyy-MM"), F.lit("-01-00"))
    write_bronze_sales(_fx(spark, sf_dir, "sales"), lake, partition_col=monthly)
    return read_lineage(spark, lake).select("target_layer", "dataset", "partition", "record_count",
                                            F.col("extra")["source"].alias("source"))


def _summaries(spark, sf_dir, name: str, piece_keys: int) -> Lake:
    """Yearly summaries of the sales in a lake."""
    lake = _lake(spark, name)
    yearly = q_silver_sales(spark, sf_dir).withColumn("partition", year_partition())
    path = f"{lake.root}/rollup"
    sales.sales_rollup(yearly, ["partition"]).write.parquet(path)
    summary.write_summaries(spark.read.parquet(path), lake, FIXED_REPORT_DATE, FIXED_NOW, piece_keys=piece_keys)
    return lake


def q_summary_index(spark, sf_dir):
    """K5: the documents as written, their maps spelled out in key order."""
    index = summary.read_summary_index(spark, _summaries(spark, sf_dir, "summary", summary.PIECE_KEYS))
    spelled = [F.array_join(F.transform(F.sort_array(F.map_entries(c)), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string"))), ";").alias(c) for c in summary.SECTIONS]
    return index.select("partition", "report_date", "total_orders", "total_revenue", "avg_order_value", *spelled,
                        "by_region_keys", "by_product_keys")


def q_summary_breakdowns(spark, sf_dir):
    """A4 of breakdowns too wide for their document: the pieces, joined."""
    return summary.read_breakdowns(spark, _summaries(spark, sf_dir, "pieces", 4))


# ---- scans of the reference's own file layouts, whole runs, published views (S9-S11, S14, K6, K10, O3, C2, V0, X6) ----

def q_json_array_scan(spark, sf_dir):
    """Headers in files that hold one JSON array each, 64 of them."""
    path = f"{_lake(spark, 'json').root}/invoice_header"
    rows = _fx(spark, sf_dir, "invoice_header").withColumn("file", F.pmod(F.xxhash64("inv_num"), F.lit(64)))
    array = F.to_json(F.collect_list(F.struct("inv_num", "cust_num", "RecordDate")), {"ignoreNullFields": "false"})
    rows.groupBy("file").agg(array.alias("value")).write.partitionBy("file").text(path)
    return read_json_array(spark, f"{path}/*/part-*", schemas.BRONZE["invoice_header"])


def q_csv_scan(spark, sf_dir):
    """Typed CSV over a wildcard of partition folders, header rows skipped, partition from the path."""
    path, fields = f"{_lake(spark, 'csv').root}/sales", schemas.BRONZE["sales"]
    rows = _fx(spark, sf_dir, "sales").withColumn("customer_id", F.when(F.col("order_id") % 9 > 0, F.col("customer_id"))
                                                  .otherwise(""))
    for year in (1996, 2000):
        rows.where(F.year("order_date") == year).write.option("header", True) \
            .csv(f"{path}/{year}-01-01-00")  # an empty text is quoted, a missing one is not
    return read_csv_layer(spark, f"{path}/*/*.csv", fields)


def q_ingest_run(spark, sf_dir):
    """S14 + A8: two runs over all client tables; the second finds nothing new in the incremental ones."""
    lake, out = _lake(spark, "runs"), None
    for hour in (10, 11):
        run = ingest.ingest_all(spark, CLIENT_TABLES, lake, ingest.hour_partition(_dt.datetime(2001, 9, 1, hour)),
                                lambda s: _fx(spark, sf_dir, s.target_table))
        rows = run.select(F.lit(hour).alias("hour"), "table", "mode", "rows_synced", "skipped", "error")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_gold_run(spark, sf_dir):
    """K4 + K6 + O3: lineage of a gold build whose sources are of different hours."""
    lake = _lake(spark, "gold-run")
    for hour, table in enumerate(gold.GOLD_SOURCES["margin_invoice"]):
        ingest.ingest_table(spark, spec(table), lake, ingest.hour_partition(_dt.datetime(2001, 9, 1, 5 - hour)),
                            lambda s: _fx(spark, sf_dir, s.target_table))
    gold.build_gold(spark, lake, ["margin_invoice", "fact_order_item", "dim_customer"])
    return read_lineage(spark, lake).select("target_layer", "dataset", "partition", "record_count",
                                            F.array_join("source_tables", ",").alias("source_tables"))


def q_margin_without_order_keys(spark, sf_dir):
    """Lines without the optional order columns have no product name and fan out over no order line."""
    lines = _fx(spark, sf_dir, "invoice_item").drop("co_num", "co_line", "item")
    return margin.margin_invoice(lines, _fx(spark, sf_dir, "invoice_header"), _fx(spark, sf_dir, "order_item"),
                                 _fx(spark, sf_dir, "customer_address"))


def q_serving_views(spark, sf_dir):
    """V0 + X6: status, rows and sample size of every requested view."""
    lake = _lake(spark, "views")
    write_gold(q_dim_customer(spark, sf_dir), lake, "dim_customer", FIXED_PARTITION, ["customer_address"])
    write_gold(q_margin_rebate(spark, sf_dir), lake, "margin_rebate", FIXED_PARTITION, ["general_ledger"])
    status = create_views(spark, lake, ["dim_customer", "margin_rebate", "sales_by_region", "no_such_view"])
    made = [v for v, st in status.items() if st == "created"]
    counts = {v: spark.table(v).agg(F.count(F.lit(1)).alias("n")) for v in made}
    samples = {v: df.agg(F.count(F.lit(1)).alias("n")) for v, df in sample_views(spark, made, 3).items()}
    out = None
    for view, st in status.items():
        row = spark.range(1).select(F.lit(view).alias("view"), F.lit(st).alias("status"), *[
            (of[view].scalar() if view in of else F.lit(None).cast("bigint")).alias(name)
            for of, name in ((counts, "rows"), (samples, "sample_rows"))])
        out = row if out is None else out.unionByName(row)
    return out


def _stream_gold(spark, lake: Lake) -> DataFrame:
    fields = schemas.with_fields(schemas.GOLD["sales_by_region"], ("partition", "string"))
    return spark.read.schema(fields).parquet(lake.path("gold", "sales_by_region")) \
        .select("partition", "region", "order_count", "total_quantity", "total_revenue", "report_date")


def q_stream_reland(spark, sf_dir):
    """Partitions that land twice, and a stream that starts over, count every row once."""
    lake = _lake(spark, "reland")
    source = _stored(spark, lake, sf_dir, "sales")
    for checkpoint in ("one", "one", "two"):
        write_bronze_sales(source, lake, partition_col=year_partition())
        run_available_now(spark, lake, report_date=FIXED_REPORT_DATE, now=FIXED_NOW,
                          checkpoint=lake.checkpoints(checkpoint))
    return _stream_gold(spark, lake)


def q_stream_after_batch(spark, sf_dir):
    """The batch flow and the stream share one silver layout."""
    lake = _lake(spark, "after-batch")
    write_bronze_sales(_fx(spark, sf_dir, "sales"), lake, partition_col=year_partition())
    run_sales_flow(spark, lake, "1996-01-01-00", FIXED_REPORT_DATE, FIXED_NOW)
    run_available_now(spark, lake, report_date=FIXED_REPORT_DATE, now=FIXED_NOW)
    return _stream_gold(spark, lake)


# ---- coercions on hard inputs (D1, M3) and the typed serving views (V1-V10) -------------------------

def q_date_layouts(spark, sf_dir):
    return _fx(spark, sf_dir, "dated_text").select("id", F.to_date(parse_timestamp(F.col("text"))).alias("parsed"))


def q_large_measures(spark, sf_dir):
    return facts.fact_invoice(_fx(spark, sf_dir, "large_item"))


def _typed_view(name: str, source: Query) -> Query:
    return lambda spark, sf_dir: typed_view_frame(source(spark, sf_dir), VIEWS[name][2])


QUERIES: dict[str, Query] = {
    "margin_invoice": q_margin_invoice,
    "fact_invoice": q_fact_invoice,
    "fact_invoice_detail": q_fact_invoice_detail,
    "fact_order_item": q_fact_order_item,
    "dim_customer": q_dim_customer,
    "fact_general_ledger": q_fact_general_ledger,
    "margin_rebate": q_margin_rebate,
    "silver_sales": q_silver_sales,
    "sales_by_region": q_sales_by_region,
    "sales_by_product": q_sales_by_product,
    "daily_summary": q_daily_summary,
    "daily_summary_by_region": q_daily_summary_by_region,
    "daily_summary_by_product": q_daily_summary_by_product,
    "sales_rollup": q_sales_rollup,
    "ingest_full_filtered": q_ingest_full_filtered,
    "ingest_incremental": q_ingest_incremental,
    "ingest_date_partition": q_ingest_date_partition,
    "incremental_watermark": q_incremental_watermark,
    "latest_partition_scan": q_latest_partition_scan,
    "partition_list": q_partition_list,
    "gold_all_partitions": q_gold_all_partitions,
    "current_by_key": q_current_by_key,
    "source_count": q_source_count,
    "source_sample": q_source_sample,
    "sync_latest": q_sync_latest,
    "sync_summary": q_sync_summary,
    "sync_state_from_snapshot": q_sync_state_from_snapshot,
    "live_batches_from_snapshot": q_live_batches_from_snapshot,
    "stale_syncs": q_stale_syncs,
    "bronze_audit": q_bronze_audit,
    "quality_minima": q_quality_minima,
    "view_typed_ids": q_view_typed_ids,
    "verification_report": q_verification_report,
    "stream_sales_by_region": q_stream_sales_by_region,
    "ingest_roundtrip_incremental": q_ingest_roundtrip_incremental,
    "ingest_two_date_partitions": q_ingest_two_date_partitions,
    "gold_rebuild_empty": q_gold_rebuild_empty,
    "gold_latest_after_rerun": q_gold_latest_after_rerun,
    "gold_current_from_lake": q_gold_current_from_lake,
    "gold_margin_from_lake": q_gold_margin_from_lake,
    "current_lines_from_lake": q_current_lines_from_lake,
    "silver_gate": q_silver_gate,
    "landing_lineage": q_landing_lineage,
    "summary_index": q_summary_index,
    "summary_breakdowns": q_summary_breakdowns,
    "json_array_scan": q_json_array_scan,
    "csv_scan": q_csv_scan,
    "ingest_run": q_ingest_run,
    "gold_run": q_gold_run,
    "margin_without_order_keys": q_margin_without_order_keys,
    "serving_views": q_serving_views,
    "stream_reland": q_stream_reland,
    "stream_after_batch": q_stream_after_batch,
    "date_layouts": q_date_layouts,
    "large_measures": q_large_measures,
}
VIEW_SOURCES: dict[str, Query] = {
    "fact_invoice": q_fact_invoice, "fact_invoice_detail": q_fact_invoice_detail, "fact_order_item": q_fact_order_item,
    "dim_customer": q_dim_customer, "margin_invoice": q_margin_invoice, "margin_rebate": q_margin_rebate,
    "sales_by_region": q_sales_by_region, "sales_by_product": q_sales_by_product, "silver_sales": q_silver_sales,
}
QUERIES.update({f"view_{name}": _typed_view(name, source) for name, source in VIEW_SOURCES.items()})
