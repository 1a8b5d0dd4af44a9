"""Command-line jobs run in-process against a scratch lake and embedded Derby."""

import uuid

from lakestrata import jobs
from lakestrata.plans.lake import Lake
from lakestrata.plans.sales_flow import write_bronze_sales
from lakestrata.sources.fixtures import load

SF = "/root/testdata/sf0.001"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_ingest_gold_verify_jobs(spark, lake_root, monkeypatch):
    url = f"jdbc:derby:memory:jobs{uuid.uuid4().hex[:8]};create=true"
    hdr = load(spark, SF, "invoice_header")
    hdr.write.format("jdbc").option("url", url).option("dbtable", "dbo.inv_hdr_mst").option("driver", DRIVER).save()
    monkeypatch.setenv("LS_TEST_PW", "unused")
    out = jobs.main(["ingest", "--lake", lake_root, "--jdbc-url", url, "--jdbc-driver", DRIVER,
                     "--jdbc-password-env", "LS_TEST_PW", "--tables", "invoice_header",
                     "--partition", "2001-09-01-00", "--parallel", "invoice_header=cust_num:3",
                     "--identifier-quote", '"'], spark)
    assert [(t["table"], t["rows_synced"], t["mode"]) for t in out["tables"]] == [
        ("invoice_header", hdr.count(), "full")]
    gold = jobs.main(["build-gold", "--lake", lake_root, "--tables", "fact_invoice_detail"], spark)
    assert gold["tables"]["fact_invoice_detail"] == {"partition": "2001-09-01-00", "rows": hdr.count()}
    views = jobs.main(["views", "--lake", lake_root, "--views", "fact_invoice_detail,margin_invoice,nope"], spark)
    assert views["views"] == {"fact_invoice_detail": {"status": "created", "sample_rows": 5},
                              "margin_invoice": {"status": "skipped", "sample_rows": None},
                              "nope": {"status": "error", "sample_rows": None}}
    ver = jobs.main(["verify", "--lake", lake_root, "--tables", "invoice_header"], spark)
    # just ingested: fresh, and its one partition audits OK; the full report is in the lake
    assert (ver["bronze_partitions_not_ok"], ver["stale_tables"]) == (0, [])
    assert set(ver["rows_by_section"]) == {"sync_summary", "table_state", "bronze_audit"}
    assert spark.read.parquet(ver["report_path"]).count() == sum(ver["rows_by_section"].values())
    vac = jobs.main(["vacuum-bronze", "--lake", lake_root, "--tables", "invoice_header,order_item"], spark)
    assert vac["dropped"] == {"invoice_header": 0, "order_item": 0}  # nothing stale to drop


def test_sales_flow_job(spark, lake_root):
    sales = load(spark, SF, "sales")
    write_bronze_sales(sales, Lake(lake_root), partition="2001-09-01-00")
    out = jobs.main(["sales-flow", "--lake", lake_root, "--partition", "2001-09-01-00",
                     "--report-date", "2001-09-01"], spark)
    assert out["silver_rows"] == sales.count() and out["sales_by_region"] == 5


def test_sales_stream_and_compaction_jobs(spark, lake_root):
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales")
    write_bronze_sales(sales, lake, partition="2001-09-01-00")
    assert jobs.main(["sales-stream", "--lake", lake_root, "--report-date", "2001-09-01"], spark)["status"] == "caught up"
    gold = spark.read.parquet(lake.path("gold", "sales_by_region"))
    assert gold.groupBy().sum("order_count").first()[0] == sales.count()
    out = jobs.main(["compact-ops", "--lake", lake_root, "--before-month", "9999-12"], spark)
    assert any("/_ops/lineage/" in p for p in out["compacted"])


def test_parallel_read_options():
    import pytest
    assert jobs.parallel_reads(["invoice_item=RecordDate:16", "order_item=co_line:4"]) == {
        "invoice_item": {"partition_column": "RecordDate", "num_partitions": 16},
        "order_item": {"partition_column": "co_line", "num_partitions": 4}}
    with pytest.raises(ValueError):
        jobs.parallel_reads(["invoice_item=RecordDate"])
