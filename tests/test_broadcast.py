"""What the planner may broadcast: nothing that only looks small as a compressed file."""

from pyspark.sql import functions as F

from lakestrata.operators.latest import newest_batch_rows
from lakestrata.plans.lake import _fs
from lakestrata.session import configure


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_by_the_size_of_a_compressed_file(spark, lake_root):
    configure(spark)
    path = f"{lake_root}/rows"
    spark.range(400_000).select(F.hex(F.xxhash64("id")).alias("k"), F.lit("b1").alias("batch_id")) \
        .write.option("compression", "zstd").parquet(path)
    fs, p = _fs(spark, path)
    assert 1 << 20 < fs.getContentSummary(p).getLength() < 32 << 20
    assert "BroadcastHashJoin" not in _plan(newest_batch_rows(spark.read.parquet(path), ["k"]))


def test_a_few_rows_are_broadcast_as_measured(spark, lake_root):
    configure(spark)
    path = f"{lake_root}/rows"
    spark.range(1000).select("id").write.parquet(path)
    df = spark.range(100_000).join(spark.read.parquet(path), "id")
    df.collect()
    assert "BroadcastHashJoin" in _plan(df)
