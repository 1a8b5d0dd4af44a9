import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.sales import sales_rollup, summary_document
from lakestrata.plans.lake import Lake
from lakestrata.plans.summary import PIECES, read_breakdowns, read_summary_index, write_summaries

SCHEMA = "order_id int, product string, region string, quantity int, total_amount decimal(18,2)"


def silver(spark, products, copies=2):
    return spark.range(products * copies).selectExpr(
        "CAST(id AS INT) AS order_id", f"concat('p', id % {products}) AS product", "concat('r', id % 5) AS region",
        "1 AS quantity", "CAST(id % 97 + 0.25 AS DECIMAL(18,2)) AS total_amount")


def stored(spark, df, lake, by=()):
    path = f"{lake.root}/rollup-{len(by)}-{df.columns.__len__()}"
    sales_rollup(df, by).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_many_products_in_bounded_pieces(spark, lake_root):
    lake, df = Lake(lake_root), silver(spark, 60_000)
    write_summaries(stored(spark, df, lake), lake, "2025-01-01", "2025-01-01 12:00:00", "2025-01-01-00", piece_keys=1000)
    pieces = spark.read.schema(PIECES).json(lake.path("gold", "daily_summary_pieces"))
    sizes = pieces.where("section = 'by_product'").agg(F.max("n"), F.sum("n"), F.max(F.size("entries"))).first()
    assert tuple(sizes) == (1000, 60_000, 1000)
    spans = sorted((r.first_key, r.last_key) for r in pieces.where("section = 'by_product'").collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # range-sorted, without overlap
    index = read_summary_index(spark, lake).first()
    assert index.by_product is None and index.by_product_keys == 60_000 and index.by_product_pieces == len(spans)
    assert set(index.by_region) == {f"r{k}" for k in range(5)} and index.total_orders == 120_000
    want = df.groupBy("product").agg(F.sum("total_amount").cast("decimal(28,2)").alias("v"))
    got = read_breakdowns(spark, lake).where("section = 'by_product'").select(F.col("key").alias("product"), "total_revenue")
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


@pytest.mark.parametrize("piece_keys", [1, 3, 10_000])
def test_same_entries_at_every_piece_size(spark, lake_root, piece_keys):
    lake = Lake(lake_root)
    rows = [(1, "a", "x", 1, Decimal("1.5")), (2, None, "x", 1, Decimal("2")), (3, "b", None, 1, None),
            (4, 'q"\u00fc\n', "", 1, Decimal("-3")), (5, "c", "y", 1, Decimal("0.01"))]
    df = spark.createDataFrame(rows, SCHEMA)
    write_summaries(stored(spark, df, lake), lake, "2025-01-01", "2025-01-01 12:00:00", "p", piece_keys=piece_keys)
    want = summary_document(df, "2025-01-01", "p", "2025-01-01 12:00:00").first()
    got = {(r.section, r.key): r.total_revenue for r in read_breakdowns(spark, lake).collect()}
    assert got == {(s, k): v for s in ("by_region", "by_product") for k, v in want[s].items()}
    index = read_summary_index(spark, lake).first()
    for c in ("report_date", "total_orders", "total_revenue", "avg_order_value"):
        assert index[c] == want[c]
    for s in ("by_region", "by_product"):
        assert index[s] == (want[s] if len(want[s]) <= piece_keys else None)


def test_a_rerun_does_not_mix_and_an_empty_partition_is_zero(spark, lake_root):
    lake = Lake(lake_root)
    for df in (silver(spark, 7), silver(spark, 3), silver(spark, 3).where("false")):
        write_summaries(stored(spark, df, lake), lake, "2025-01-01", "2025-01-01 12:00:00", "p", piece_keys=2)
        assert read_breakdowns(spark, lake).where("section = 'by_product'").count() == df.select("product").distinct().count()
    index = read_summary_index(spark, lake).first()
    assert (index.total_orders, index.by_region, index.by_product) == (0, {}, {})


def test_several_partitions_at_once(spark, lake_root):
    lake, df = Lake(lake_root), silver(spark, 12).withColumn("partition", F.concat(F.lit("p"), F.col("order_id") % 3))
    write_summaries(stored(spark, df, lake, ["partition"]), lake, "2025-01-01", "2025-01-01 12:00:00", piece_keys=5)
    index = {r.partition: r for r in read_summary_index(spark, lake).collect()}
    assert set(index) == {"p0", "p1", "p2"} and all(len(r.by_product) == 4 for r in index.values())
    folder = lake_root.removeprefix("file:") + "/gold/daily_summary/partition=p1"
    (name,) = [f for f in os.listdir(folder) if f.endswith(".json")]
    document = json.loads(open(f"{folder}/{name}").read())  # one JSON object a partition
    assert document["by_region_keys"] == 5 and len(document["by_region"]) == 5
