
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.facts import fact_invoice
from lakestrata.operators.margin import margin_invoice
from lakestrata.operators.sales import enrich_sales
from lakestrata.plans import synclog
from lakestrata.plans.gold import build_gold
from lakestrata.plans.ingest import ingest_table
from lakestrata.plans.lake import Lake, read_lineage, write_gold
from lakestrata.plans.sales_flow import run_sales_flow, write_bronze_sales
from lakestrata.plans.views import create_views
from lakestrata.sources.jdbc import frame_reader
from lakestrata.specs import Pattern, TableSpec, spec

from tests.conftest import rows

T = dt.datetime


def _item(spark, data):
    return spark.createDataFrame(data, schemas.BRONZE["invoice_item"])


def test_ansi_stays_on_and_junk_never_throws(spark):
    # Q8: ANSI mode is left on; coercions use try_cast, so junk text gives 0 / null, not an error
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = _item(spark, [("I", 1, "C", 1, "P", "garbage", "abc", "1e999", "--", None)])
    r = fact_invoice(df).first()
    assert r.InvoiceDate is None and r.QtyInvoiced == 0 and r.ExtendedPrice == 0


def test_invoice_date_types_and_view_cast(spark, lake_root):
    # Q11: fact_invoice keeps a timestamp, margin_invoice a date; the view declares DATE for both
    item = _item(spark, [("INV1", 1, "CO1", 1, "P1", "2025-01-15 10:30:00", "1", "2", "1", None)])
    header = spark.createDataFrame([("INV1", 5, None)], schemas.BRONZE["invoice_header"])
    order_item = spark.createDataFrame([], schemas.BRONZE["order_item"])
    address = spark.createDataFrame([(5, 0, "x")], schemas.BRONZE["customer_address"])
    fi = fact_invoice(item)
    assert dict(fi.dtypes)["InvoiceDate"] == "timestamp_ntz"
    assert fi.first().InvoiceDate == T(2025, 1, 15, 10, 30)
    mi = margin_invoice(item, header, order_item, address)
    assert dict(mi.dtypes)["InvoiceDate"] == "date" and mi.first().InvoiceDate == dt.date(2025, 1, 15)
    lake = Lake(lake_root)
    write_gold(fi, lake, "fact_invoice", "2025-01-15-00", ["invoice_item"])
    assert create_views(spark, lake, ["fact_invoice"]) == {"fact_invoice": "created"}
    v = spark.table("fact_invoice")
    assert dict(v.dtypes)["InvoiceDate"] == "date" and v.first().InvoiceDate == dt.date(2025, 1, 15)


def test_base_columns_with_joined_names_do_not_collide(spark):
    # Q17 fix: base columns named like joined ones (description, cust_num, name) change nothing
    item = _item(spark, [("INV1", 1, "CO1", 1, "P1", "2025-01-15", "2", "3", "1", None)])
    header = spark.createDataFrame([("INV1", 5, None)], schemas.BRONZE["invoice_header"])
    order_item = spark.createDataFrame([("CO1", 1, "P1", "1", "1", "1", "1", "Widget", None)],
                                       schemas.BRONZE["order_item"])
    address = spark.createDataFrame([(5, 0, "OMNICARE")], schemas.BRONZE["customer_address"])
    plain = rows(margin_invoice(item, header, order_item, address))
    wide = item.withColumns({"description": F.lit("base text"), "cust_num": F.lit(99), "name": F.lit("n")})
    hdr_wide = header.withColumn("description", F.lit("hdr text"))
    got = rows(margin_invoice(wide, hdr_wide, order_item, address))
    assert got == plain
    r = margin_invoice(wide, hdr_wide, order_item, address).first()
    assert (r.ProductName, r.CustomerID, r.CustomerName) == ("Widget", 5, "CVS/Omnicare")
    assert r.ExtendedPrice == Decimal("6.0000") and r.Margin == Decimal("4.0000")


def test_every_run_is_logged(spark, lake_root):
    # Q27 fix: full-refresh tables get a sync-log row too, told apart by sync_type
    lake = Lake(lake_root)
    addr = spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], schemas.BRONZE["customer_address"])
    ingest_table(spark, spec("customer_address"), lake, "2025-01-01-00", frame_reader({"customer_address": addr}))
    st = synclog.get_state(spark, lake, "customer_address")
    assert st is not None and st.rows_synced == 2 and st.last_sync_value is None
    log = synclog.read_log(spark, lake).first()
    assert (log.sync_type, log.mode, log.status) == ("full_refresh", "full", "ok")


def test_views_read_all_partitions_or_latest(spark, lake_root):
    # Q30: snapshot tables repeat once per run under scope 'all'; 'latest' keeps the newest
    lake = Lake(lake_root)
    dim = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "CustomerID int, CustomerSequence int, CustomerName string")
    for p in ("2025-01-01-00", "2025-01-02-00"):
        write_gold(dim, lake, "dim_customer", p, ["customer_address"])
    assert create_views(spark, lake, ["dim_customer"]) == {"dim_customer": "created"}
    assert spark.table("dim_customer").count() == 4
    create_views(spark, lake, ["dim_customer"], scope="latest")
    assert spark.table("dim_customer").count() == 2


def test_gold_partition_is_newest_source_and_each_table_reads_its_own_latest(spark, lake_root):
    # Q31 + Q36: margin_invoice goes to the newest of its four sources' partitions; each
    # source is read at its own newest partition
    lake = Lake(lake_root)
    item = _item(spark, [("INV1", 1, "CO1", 1, "P1", "2025-01-15", "1", "2", "1", T(2025, 1, 15))])
    header = spark.createDataFrame([("INV1", 5, T(2025, 1, 15))], schemas.BRONZE["invoice_header"])
    order_item = spark.createDataFrame([("CO1", 1, "P1", "1", "1", "1", "1", "Widget", T(2025, 1, 15))],
                                       schemas.BRONZE["order_item"])
    old_addr = spark.createDataFrame([(5, 0, "Old name")], schemas.BRONZE["customer_address"])
    new_addr = spark.createDataFrame([(5, 0, "New name")], schemas.BRONZE["customer_address"])
    frames = {"invoice_item": item, "invoice_header": header, "order_item": order_item,
              "customer_address": old_addr}
    for t in frames:
        ingest_table(spark, spec(t), lake, "2025-01-15-08", frame_reader(frames))
    ingest_table(spark, spec("customer_address"), lake, "2025-01-15-12",
                 frame_reader({"customer_address": new_addr}))
    res = build_gold(spark, lake, ["margin_invoice"])["margin_invoice"]
    assert res.partition == "2025-01-15-12" and res.rows == 1
    out = spark.read.parquet(lake.path("gold", "margin_invoice")).first()
    assert (out.partition, out.CustomerName) == ("2025-01-15-12", "New name")


def test_identifiers_are_validated_whole(spark):
    # Q35 fix: identifiers must match entirely (a trailing newline is rejected)
    with pytest.raises(ValueError):
        TableSpec("inv_item_mst\n", "invoice_item")
    with pytest.raises(ValueError):
        TableSpec("inv_item_mst; DROP TABLE x", "invoice_item")
    with pytest.raises(ValueError):
        TableSpec("t", "t", Pattern.INCREMENTAL)  # incremental needs a timestamp column


def test_summary_document_has_lineage_and_fixed_clock(spark, lake_root):
    # Q37 fix: the summary document gets a lineage record; Q38: wall-clock values are parameters
    lake = Lake(lake_root)
    sales = spark.createDataFrame([(1, "C1", "Widget A", 2, Decimal("1.50"), dt.date(2025, 1, 1), "East")],
                                  schemas.BRONZE["sales"])
    write_bronze_sales(sales, lake, partition="2025-01-01-00")
    now = T(2025, 1, 1, 12, 0)
    run_sales_flow(spark, lake, "2025-01-01-00", report_date="2025-01-01", now=now)
    lin = read_lineage(spark, lake).where(F.col("dataset") == "daily_summary").collect()
    assert len(lin) == 1 and lin[0].source_tables == ["sales"] and lin[0].partition == "2025-01-01-00"
    assert enrich_sales(sales, now).first().processed_at == now
