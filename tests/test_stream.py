import os

from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.sales import enrich_sales
from lakestrata.plans.lake import Lake, read_lineage
from lakestrata.plans.sales_flow import write_bronze_sales
from lakestrata.sources.fixtures import load
from lakestrata.streaming.sales_stream import run_available_now

SF = "/root/testdata/sf0.001"


def month():
    return F.concat(F.date_format("order_date", "yyyy-MM"), F.lit("-01-00"))


def _gold(spark, lake):
    return spark.read.parquet(lake.path("gold", "sales_by_region"))


def _expected(df):
    silver = enrich_sales(df.withColumn("partition", month())).where("region IS NOT NULL")
    return silver.groupBy("partition", "region").agg(
        F.count("order_id").alias("order_count"), F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("total_amount").cast("decimal(28,2)").alias("total_revenue"))


def _norm(df):
    return sorted(tuple(r) for r in df.select("partition", "region", "order_count", "total_quantity",
                                              "total_revenue").collect())


def test_stream_processes_each_file_once(spark, lake_root):
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales")
    # landings replace the bronze partitions that they write, so the cut lies between two partitions
    cut = sales.agg(F.unix_date(F.to_date(F.date_trunc("month", F.percentile_approx("order_date", 0.5)))).alias("d")) \
        .first().d
    first = sales.where(F.unix_date("order_date") < cut)
    later = sales.where(F.unix_date("order_date") >= cut)
    assert first.count() > 0 and later.count() > 0
    assert write_bronze_sales(first, lake, partition_col=month()) == first.count()
    run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00")
    assert _norm(_gold(spark, lake)) == _norm(_expected(first))
    silver_root = lake.path("silver", "sales").replace("file:", "")
    before = {p: sorted(os.listdir(os.path.join(silver_root, p))) for p in os.listdir(silver_root)
              if p.startswith("partition=")}

    # new files arrive; the second run reads only those
    write_bronze_sales(later, lake, partition_col=month())
    run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00")
    assert _norm(_gold(spark, lake)) == _norm(_expected(sales))
    after = {p: sorted(os.listdir(os.path.join(silver_root, p))) for p in os.listdir(silver_root)
             if p.startswith("partition=")}
    arrived = {"partition=" + r[0] for r in later.select(month()).distinct().collect()}
    for p, epochs in before.items():
        assert p not in arrived and after[p] == epochs  # partitions without new files are untouched
    assert arrived and arrived <= set(after)
    silver = spark.read.schema(schemas.with_fields(schemas.SILVER_SALES, ("partition", "string"), ("epoch", "int"))) \
        .parquet(lake.path("silver", "sales"))
    assert silver.count() == sales.count()  # every row exactly once
    # one lineage record per written partition; silver counts add up to every row once
    lin = read_lineage(spark, lake)
    silver_lin = lin.where(F.col("target_layer") == "silver").agg(F.sum("record_count").alias("n")).first().n
    assert silver_lin == sales.count()
    landed = lin.where(F.col("target_layer") == "bronze").agg(F.sum("record_count").alias("n")).first().n
    assert landed == sales.count()  # the two landings recorded every row once, per partition
    gold_parts = {r.partition for r in lin.where(F.col("dataset") == "sales_by_region").collect()}
    assert gold_parts == {p.split("=", 1)[1] for p in after}


def test_retried_epoch_writes_lineage_once(spark, lake_root):
    # a retried epoch replaces the silver partition and does not repeat its lineage
    from lakestrata.streaming.sales_stream import _process
    lake = Lake(lake_root)
    rows = load(spark, SF, "sales").limit(50).withColumn("partition", F.lit("2001-09-01-00"))
    batch = spark.createDataFrame(rows.collect(), rows.schema)
    write_bronze_sales(batch.drop("partition"), lake, partition="2001-09-01-00")
    for _ in range(2):
        _process(lake, "2001-09-01", "2001-09-01 00:00:00", "stream-a", batch, 7)
    lin = read_lineage(spark, lake)
    assert lin.where(F.col("target_layer") == "silver").count() == 1
    assert lin.where(F.col("target_layer") == "gold").count() == 3  # by region, by product, summary
    silver = spark.read.parquet(lake.path("silver", "sales"))
    assert silver.count() == 50  # the partition was replaced, not appended to
    _process(lake, "2001-09-01", "2001-09-01 00:00:00", "stream-b", batch, 7)  # another stream, same epoch id
    assert read_lineage(spark, lake).where(F.col("target_layer") == "silver").count() == 2


def test_backlog_is_drained_in_bounded_micro_batches(spark, lake_root):
    # availableNow with a per-trigger cap: several epochs, every row exactly once
    from lakestrata.streaming.sales_stream import start_sales_stream
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales")
    write_bronze_sales(sales, lake, partition_col=month())
    q = start_sales_stream(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00", max_files_per_trigger=5)
    q.awaitTermination()
    assert q.exception() is None and q.lastProgress is not None and q.lastProgress["batchId"] >= 1
    silver = spark.read.schema(schemas.with_fields(schemas.SILVER_SALES, ("partition", "string"), ("epoch", "int"))) \
        .parquet(lake.path("silver", "sales"))
    assert silver.count() == sales.count()
    assert _norm(_gold(spark, lake)) == _norm(_expected(sales))


def test_stream_summary_documents_match_the_batch_document(spark, lake_root):
    # K5 in the stream: one document per touched partition, equal to the batch flow's document
    from lakestrata.operators.sales import summary_document
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales")
    write_bronze_sales(sales, lake, partition_col=month())
    run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00")
    doc_schema = schemas._struct(*[(f.name, f.dataType) for f in schemas.GOLD["daily_summary"].fields
                                   if f.name != "partition"], ("partition", schemas.S))
    docs = {r.partition: r for r in spark.read.schema(doc_schema).json(lake.path("gold", "daily_summary")).collect()}
    silver = spark.read.schema(schemas.with_fields(schemas.SILVER_SALES, ("partition", "string"), ("epoch", "int"))) \
        .parquet(lake.path("silver", "sales"))
    assert set(docs) == {r.partition for r in silver.select("partition").distinct().collect()}
    for p in sorted(docs)[:3]:
        part = silver.where(F.col("partition") == p).drop("partition", "epoch")
        want = summary_document(part, "2001-09-01", p, "2001-09-01 00:00:00").first()
        got = docs[p]
        for field in ("report_date", "total_orders", "total_revenue", "avg_order_value", "by_region", "by_product"):
            assert got[field] == want[field], (p, field)


def test_repeated_landing_new_checkpoint_and_batch_flow_agree(spark, lake_root):
    # a partition landed again, a stream with a new checkpoint and the batch flow on the same lake
    from lakestrata.plans.sales_flow import run_sales_flow
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales")
    write_bronze_sales(sales, lake, partition_col=month())
    part = sales.select(month().alias("p")).agg(F.min("p").alias("p")).first().p
    run_sales_flow(spark, lake, part, "2001-09-01", "2001-09-01 00:00:00")
    for checkpoint in ("one", "two"):
        run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00",
                          checkpoint=lake.checkpoints(checkpoint))
    write_bronze_sales(sales, lake, partition_col=month())
    run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00", checkpoint=lake.checkpoints("two"))
    assert _norm(_gold(spark, lake)) == _norm(_expected(sales))
    assert spark.read.parquet(lake.path("silver", "sales")).count() == sales.count()


def test_gate_is_per_partition(spark, lake_root):
    # one bad partition is left out and reported; the others are served
    lake = Lake(lake_root)
    rows = load(spark, SF, "sales").limit(40)
    write_bronze_sales(rows, lake, partition="2001-09-01-00")
    write_bronze_sales(rows.withColumn("quantity", F.lit(0)), lake, partition="2001-09-01-01")
    run_available_now(spark, lake, report_date="2001-09-01", now="2001-09-01 00:00:00", max_files_per_trigger=1)
    assert {r.partition for r in _gold(spark, lake).select("partition").distinct().collect()} == {"2001-09-01-00"}
    bad = read_lineage(spark, lake).where("target_layer = 'rejected'").collect()
    assert {(r.partition, r.extra["reason"].split(",")[0]) for r in bad} == {("2001-09-01-01", "min_quantity=0")}
