"""A key holding a third of all rows must not land in one task."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.latest import current_by_key
from lakestrata.operators.margin import margin_invoice
from lakestrata.schemas import BRONZE


@pytest.fixture
def tiny_thresholds(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_inputs(spark, n=30000, hot="HOT"):
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("string"))
        .otherwise(F.concat(F.lit("INV"), F.col("id").cast("string"))).alias("inv_num"), F.lit(1).alias("inv_line"), F.concat(F.lit("CO"), F.col("id").cast("string")).alias("co_num"),
        F.lit(1).alias("co_line"), F.lit("P").alias("item"), F.lit("2025-01-01").alias("tax_date"),
        F.lit("1").alias("qty_invoiced"), F.lit("2").alias("price"), F.lit("1").alias("cost"),
        F.lit(None).cast("timestamp_ntz").alias("RecordDate"))
    headers = spark.range(n).select(F.concat(F.lit("INV"), F.col("id").cast("string")).alias("inv_num"),
                                    (F.col("id") % 100).cast("int").alias("cust_num"),
                                    F.lit(None).cast("timestamp_ntz").alias("RecordDate")) \
        .unionByName(spark.createDataFrame([("HOT", 7, None)], BRONZE["invoice_header"]))
    orders = spark.createDataFrame([], BRONZE["order_item"])
    address = spark.range(100).select(F.col("id").cast("int").alias("cust_num"), F.lit(0).alias("cust_seq"),
                                      F.lit("n").alias("name"))
    return items, headers, orders, address


def test_hot_invoice_key_is_split(spark, tiny_thresholds):
    out = margin_invoice(*_skewed_inputs(spark))
    assert len(out.collect()) == 30000  # runs this DataFrame's own plan
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "skew=true" in final  # AQE split the hot partition of the streamed (left) side


def test_hot_key_latest_version_is_pre_aggregated(spark):
    # 1/3 of the rows share one key: max_by runs map-side, the shuffle carries one row per task
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("ts"))
    out = current_by_key(df, ["k"], ["ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert out.where(F.col("k") == 0).first().ts == 29997


def test_hot_null_key_is_split(spark, tiny_thresholds):
    # a third of the lines have no invoice number: null keys match null keys (Q1), so they
    # share one join partition, which AQE splits like any hot key; no header has a null
    # key here, so those lines keep their own columns and get a null customer
    out = margin_invoice(*_skewed_inputs(spark, hot=None))
    rows = out.collect()
    assert len(rows) == 30000 and sum(r.Invoice is None for r in rows) == 10000
    assert all(r.CustomerID is None for r in rows if r.Invoice is None)
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "skew=true" in final
