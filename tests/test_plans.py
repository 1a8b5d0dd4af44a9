"""Scale properties of physical plans (no whole group in one task, pruning, pushdown)."""

import datetime as dt

from pyspark.sql import functions as F

from lakestrata import schemas
from lakestrata.plans import synclog
from lakestrata.plans.ingest import committed_batches, ingest_table, incremental_scan
from lakestrata.plans.lake import Lake, read_layer
from lakestrata.sources.fixtures import load
from lakestrata.sources.jdbc import frame_reader
from lakestrata.specs import spec

SF = "/root/testdata/sf0.001"


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sync_state_has_no_window_and_pre_aggregates(spark):
    # a table holding most of the runs is folded per task before the shuffle
    plan = synclog.sync_states(load(spark, SF, "sync_log"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_max_by" in plan and "partial_sum" in plan


def test_committed_batch_read_prunes_batch_folders(spark, lake_root):
    # uncommitted / superseded batch folders are pruned at run time, not read and dropped
    lake = Lake(lake_root)
    hdr = load(spark, SF, "invoice_header")
    ingest_table(spark, spec("invoice_header"), lake, "2001-09-01-00", frame_reader({"invoice_header": hdr}))
    df = read_layer(spark, lake, "bronze", "invoice_header", schemas.BRONZE["invoice_header"], "all",
                    committed_batches=committed_batches(spark, lake, "invoice_header"))
    plan = _executed(df)
    assert "dynamicpruningexpression(batch_id" in plan
    assert df.count() == hdr.count()


def test_latest_partition_read_is_pruned_at_plan_time(spark, lake_root):
    lake = Lake(lake_root)
    hdr = load(spark, SF, "invoice_header")
    for p in ("2001-09-01-00", "2001-09-01-01"):
        ingest_table(spark, spec("invoice_header"), lake, p, frame_reader({"invoice_header": hdr}), force_full=True)
    df = read_layer(spark, lake, "bronze", "invoice_header", schemas.BRONZE["invoice_header"], "latest")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in plan and "(partition#" in plan and "= 2001-09-01-01)" in plan


def test_watermark_filter_reaches_the_parquet_scan(spark):
    # The incremental predicate is pushed into the source scan as column > literal
    src = load(spark, SF, "invoice_header")
    df = incremental_scan(src, "RecordDate", dt.datetime(1998, 1, 1, 12, 30, 15, 999))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):]
    pushed = pushed[:pushed.index("]")]
    assert "GreaterThan(o_orderdate,1998-01-01T12:30:15)" in pushed  # truncated to the second (Q21)
    assert df.count() == src.where(F.col("RecordDate") > F.lit("1998-01-01 12:30:15").cast("timestamp_ntz")).count()


def test_cluster_sizing():
    from lakestrata.session import sizing
    big = sizing(100 << 40, 8000)  # 100 TB on 8,000 cores: task counts capped, splits grow
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert int(big["spark.sql.files.maxPartitionBytes"]) == -(-(100 << 40) // 100_000)  # ~1 GiB splits
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    small = sizing(10 << 30, 64)  # 10 GB: default 128 MB splits, at least 2 partitions per core
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20
    assert int(small["spark.sql.shuffle.partitions"]) == 128


def test_no_machine_local_scratch_on_a_cluster():
    import pytest
    from lakestrata.session import local_scratch
    assert local_scratch("local[4]")
    for master in ("yarn", "spark://host:7077", "k8s://https://host"):
        with pytest.raises(ValueError):
            local_scratch(master)


def test_orphan_names_join_on_a_key_at_any_size(spark):
    # J4 without any broadcast: lines without a header find orphan addresses by an equality join
    from lakestrata.operators.margin import margin_invoice
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for c in before:
            spark.conf.set(c, "-1")
        address = spark.createDataFrame([(None, 0, f"o{k}") for k in range(2000)], "cust_num int, cust_seq int, name string")
        df = margin_invoice(load(spark, SF, "invoice_item").where("inv_line = 1"),
                            load(spark, SF, "invoice_header"), load(spark, SF, "order_item"),
                            address.where("name = 'o7'").unionByName(load(spark, SF, "customer_address")))
        plans = [df._jdf.queryExecution().executedPlan().toString(), _executed(df)]
        wide = margin_invoice(load(spark, SF, "invoice_item"), load(spark, SF, "invoice_header"),
                              load(spark, SF, "order_item"), address)
        plans.append(wide._jdf.queryExecution().executedPlan().toString())
        for plan in plans:
            assert "NestedLoop" not in plan and "IdentityBroadcast" not in plan and "Cartesian" not in plan
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_a_source_that_is_loaded_twice_is_made_once(spark, lake_root, tmp_path, monkeypatch):
    from lakestrata import queries
    from lakestrata.plans.lake import Lake
    spark.range(100).selectExpr("id as o_orderkey", "id % 7 as o_custkey",
                                "date_add(date'2000-01-01', cast(id as int)) as o_orderdate") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    loaded = []
    monkeypatch.setattr(queries.ingest, "ingest_table", lambda *a, **k: loaded.append(a[4](a[1])))
    lake = Lake(lake_root)
    queries._load_in_two(spark, lake, str(tmp_path), "invoice_header")
    part, whole = (df.count() for df in loaded)
    assert 60 < part < 75 and whole == 97  # 70 % of the days, all
    assert all("/_source/" in f for df in loaded for f in df.inputFiles())  # the raw table before, made anew by each load
