import os

import pytest
from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.operators.quality import QualityError
from lakestrata.operators.sales import enrich_sales
from lakestrata.plans.lake import Lake, read_layer, read_lineage
from lakestrata.plans.sales_flow import bronze_to_silver, gate_partitions, run_sales_flow, write_bronze_sales
from lakestrata.sources.fixtures import load
from lakestrata.streaming import sales_stream
from lakestrata.streaming.sales_stream import run_available_now, work_off

SF = "/root/testdata/sf0.001"
NOW = "2001-09-01 00:00:00"


def counted(spark, df):
    """``df`` with a counter of the rows that were evaluated."""
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(passing, df.schema), seen


def day(n):
    return F.date_format(F.expr(f"date_add(DATE'2001-01-01', CAST(order_id % {n} AS INT))"), "yyyy-MM-dd-00")


def test_a_landing_in_many_partitions_evaluates_its_input_once(spark, lake_root):
    lake, sales = Lake(lake_root), load(spark, SF, "sales").persist()
    df, seen = counted(spark, sales)
    assert write_bronze_sales(df, lake, partition_col=day(150)) == sales.count() == seen.value
    lin = read_lineage(spark, lake)
    want = {r.p: r["count"] for r in sales.groupBy(day(150).alias("p")).count().collect()}
    assert {r.partition: r.record_count for r in lin.collect()} == want and lin.count() == len(want) > 100
    assert read_layer(spark, lake, "bronze", "sales", schemas.BRONZE["sales"]).count() == sales.count()
    # landed again: the partitions are replaced, others stay, and nothing is left aside
    few = sales.where(day(150) < "2001-01-03")
    write_bronze_sales(few, lake, partition_col=day(150))
    assert read_layer(spark, lake, "bronze", "sales", schemas.BRONZE["sales"]).count() == sales.count()
    assert os.listdir(lake_root.removeprefix("file:") + "/_ops/staging") == []
    assert write_bronze_sales(sales.where("false"), lake, partition_col=day(150)) == 0
    sales.unpersist()


def test_the_gate_is_inside_the_write(spark, lake_root):
    lake, sales = Lake(lake_root), load(spark, SF, "sales").limit(60).persist()
    p = "2001-09-01-00"
    df, seen = counted(spark, sales)
    assert bronze_to_silver(spark, lake, p, NOW, bronze=df) == 60 == seen.value  # one scan
    before = sorted(map(tuple, spark.read.parquet(lake.path("silver", "sales")).collect()), key=str)
    for bad in (sales.withColumn("quantity", F.when(F.col("order_id") > 0, F.lit(0)).cast("int")), sales.where("false"),
                sales.withColumn("unit_price", F.lit(None).cast("decimal(18,2)"))):
        with pytest.raises(QualityError):
            bronze_to_silver(spark, lake, p, NOW, bronze=bad)
    assert sorted(map(tuple, spark.read.parquet(lake.path("silver", "sales")).collect()), key=str) == before
    assert read_lineage(spark, lake).where("target_layer = 'silver'").count() == 1
    assert os.listdir(lake_root.removeprefix("file:") + "/_ops/staging") == []
    write_bronze_sales(sales.limit(10), lake, partition=p)
    assert run_sales_flow(spark, lake, p, "2001-09-01", NOW)["silver_rows"] == 10
    assert spark.read.parquet(lake.path("silver", "sales")).count() == 10
    sales.unpersist()


def test_many_partitions_pass_the_gate_one_by_one(spark, lake_root):
    lake = Lake(lake_root)
    sales = load(spark, SF, "sales").withColumn("partition", day(20)).persist()
    bad = sales.withColumn("quantity", F.when(F.col("partition") == "2001-01-05-00", -1).otherwise(F.col("quantity")))
    df, seen = counted(spark, enrich_sales(bad, NOW))
    verdict = {r.partition: (r.rows, r.good) for r in gate_partitions(df, lake, lake.checkpoints("v")).collect()}
    assert seen.value == sales.count()
    assert verdict == {r.partition: (r["count"], r.partition != "2001-01-05-00")
                       for r in sales.groupBy("partition").count().collect()}
    silver = {r.partition for r in spark.read.parquet(lake.path("silver", "sales")).select("partition").distinct().collect()}
    assert silver == set(verdict) - {"2001-01-05-00"}
    sales.unpersist()


def test_a_backlog_rebuilds_a_partition_once(spark, lake_root, monkeypatch):
    lake, sales = Lake(lake_root), load(spark, SF, "sales").limit(400).repartition(20)
    for p in ("2001-09-01-00", "2001-09-01-01"):
        write_bronze_sales(sales, lake, partition=p)
    files = [f for f in os.listdir(lake_root.removeprefix("file:") + "/bronze/sales/partition=2001-09-01-00")
             if f.endswith(".parquet")]
    assert len(files) == 20
    done, gate = [], sales_stream.gate_partitions

    def watched(silver, *args):
        verdict = gate(silver, *args)
        done.extend(r.partition for r in verdict.collect())
        return verdict

    monkeypatch.setattr(sales_stream, "gate_partitions", watched)
    run_available_now(spark, lake, report_date="2001-09-01", now=NOW, max_files_per_trigger=4)
    assert sorted(done) == ["2001-09-01-00", "2001-09-01-01"]  # ten micro-batches, one rebuild
    assert spark.read.parquet(lake.path("silver", "sales")).count() == 800
    assert read_lineage(spark, lake).where("target_layer = 'silver'").count() == 2
    assert work_off(spark, lake, lake.checkpoints("sales_stream")) == []


def test_a_backlog_outlives_a_run_that_breaks_off(spark, lake_root, monkeypatch):
    lake, sales = Lake(lake_root), load(spark, SF, "sales").limit(50)
    write_bronze_sales(sales, lake, partition="2001-09-01-00")
    with monkeypatch.context() as m:
        m.setattr(sales_stream, "_newer_files", lambda *_: True)  # as if files were still to come
        q = sales_stream.start_sales_stream(spark, lake, report_date="2001-09-01", now=NOW)
        q.awaitTermination()
    assert not os.path.exists(lake_root.removeprefix("file:") + "/silver/sales")
    run_available_now(spark, lake, report_date="2001-09-01", now=NOW)  # no new file, only the backlog
    assert spark.read.parquet(lake.path("silver", "sales")).count() == 50
