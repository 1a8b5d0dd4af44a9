"""JDBC source tests on embedded in-memory Derby (in-process: no server, no port)."""

import datetime as dt
import uuid

import pytest

from lakestrata.plans import synclog
from lakestrata.plans.ingest import ingest_table, plan_load
from lakestrata.plans.lake import Lake, read_layer
from lakestrata.sources.jdbc import (
    ROW_NUMBER_QUANTILES, JdbcSource, equi_depth_predicates, jdbc_ranges, jdbc_query, jdbc_reader, jdbc_table, range_partitioning, source_row_count, source_sample,
    source_schema,
)
from lakestrata.specs import Pattern, TableSpec

T = dt.datetime


@pytest.fixture
def derby(spark):
    src = JdbcSource(f"jdbc:derby:memory:ls{uuid.uuid4().hex[:8]};create=true",
                     {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
                     limit_template="SELECT * FROM {table} FETCH FIRST {n} ROWS ONLY",
                     quantile_template=ROW_NUMBER_QUANTILES, quote='"')
    data = [(f"INV{i}", i % 7, T(2025, 1, 1) + dt.timedelta(hours=i)) for i in range(40)]
    df = spark.createDataFrame(data, "inv_num string, cust_num int, RecordDate timestamp")
    df.write.format("jdbc").option("url", src.url).option("dbtable", "inv_hdr_mst") \
        .option("driver", src.properties["driver"]).mode("overwrite").save()
    return src


SPEC = TableSpec("inv_hdr_mst", "invoice_header", Pattern.INCREMENTAL, timestamp_column="RecordDate",
                 keys=("inv_num",), schema="APP")


def test_scan_count_sample_schema(spark, derby):
    df = jdbc_table(spark, derby, "APP.INV_HDR_MST", partition_column="cust_num", lower_bound=0,
                    upper_bound=7, num_partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 40           # S1 parallel read
    assert source_row_count(spark, derby, "APP.INV_HDR_MST") == 40      # S7 at the source
    assert source_sample(spark, derby, "APP.INV_HDR_MST", 5).count() == 5  # S8
    assert jdbc_query(spark, derby, 'SELECT MAX("cust_num") AS m FROM APP.INV_HDR_MST').first().M == 6  # S5
    meta = source_schema(df).collect()                                  # S6
    assert [(r.ordinal, r.column_name) for r in meta] == [(1, "inv_num"), (2, "cust_num"), (3, "RecordDate")]


def test_incremental_filter_is_pushed_down(spark, derby):
    src = jdbc_reader(spark, derby)(SPEC)
    state = synclog.SyncState("invoice_header", "ok", T(2025, 1, 2, 3, 0, 0, 700000), None, 1, 1)
    df, mode = plan_load(SPEC, src, state)
    assert mode == "incremental"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(RecordDate), *GreaterThan(RecordDate" in plan
    assert df.count() == 12  # hours 28..39 are strictly after 03:00:00 on day 2 (truncated watermark)


def test_ingest_from_jdbc(spark, derby, lake_root):
    lake = Lake(lake_root)
    reader = jdbc_reader(spark, derby)
    r1 = ingest_table(spark, SPEC, lake, "2025-01-01-00", reader, source_name="derby")
    assert (r1["mode"], r1["rows_synced"]) == ("full", 40)
    r2 = ingest_table(spark, SPEC, lake, "2025-01-01-01", reader, source_name="derby")
    assert (r2["mode"], r2["rows_synced"], r2["skipped"]) == ("incremental", 0, True)
    got = read_layer(spark, lake, "bronze", "invoice_header", None)
    assert got.count() == 40


def test_range_partitioned_read(spark, derby):
    parts = range_partitioning(spark, derby, "APP.INV_HDR_MST", "RecordDate", 4, quote='"')
    assert parts["lower_bound"] == T(2025, 1, 1) and parts["num_partitions"] == 4
    df = jdbc_reader(spark, derby, {"invoice_header": parts})(SPEC)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 40


def test_source_count_template_and_identifier_checks(spark, derby):
    # The count query is the source's choice (statistics on SQL Server); names are validated
    from dataclasses import replace
    from lakestrata.sources.jdbc import SQLSERVER_STATS_COUNT, qualified_name
    assert source_row_count(spark, derby, "INV_HDR_MST", schema="APP") == 40
    by_catalog = replace(derby, count_template=(
        "SELECT COUNT(*) AS n FROM SYS.SYSTABLES t JOIN SYS.SYSSCHEMAS s ON t.SCHEMAID = s.SCHEMAID "
        "WHERE s.SCHEMANAME = '{schema}' AND t.TABLENAME = '{table}'"))
    assert source_row_count(spark, by_catalog, "APP.INV_HDR_MST") == 1  # the template decides the query
    assert "OBJECT_ID('dbo.inv_item_mst')" in SQLSERVER_STATS_COUNT.format(qualified=qualified_name("dbo.inv_item_mst"))
    for bad in ("APP.INV_HDR_MST; DROP TABLE X", "APP.INV_HDR_MST\n", "INV_HDR_MST WHERE 1=1"):
        with pytest.raises(ValueError):
            source_row_count(spark, derby, bad)
        with pytest.raises(ValueError):
            source_sample(spark, derby, bad)
    with pytest.raises(ValueError):
        range_partitioning(spark, derby, "APP.INV_HDR_MST", "RecordDate) FROM X --", 2)


def test_source_schema_from_jdbc_metadata(spark, derby):
    # Source type and declared length per column, in ordinal order
    spark.sql("SELECT 'a' AS code, CAST(1.5 AS DECIMAL(18,4)) AS amount").write.format("jdbc") \
        .option("url", derby.url).option("dbtable", "typed_t").option("driver", derby.properties["driver"]) \
        .option("createTableColumnTypes", "code VARCHAR(50)").save()
    meta = source_schema(jdbc_table(spark, derby, "APP.TYPED_T")).collect()
    assert [(r.ordinal, r.column_name, r.data_type, r.max_length, r.spark_type) for r in meta] == [
        (1, "code", "varchar", 50, "string"), (2, "amount", "decimal", None, "decimal(18,4)")]


def test_incremental_read_splits_the_delta_range(spark, derby, lake_root):
    # the delta (hours 28..39) is spread over the range queries, not left in one of them
    from pyspark.sql import functions as F
    parts = {"invoice_header": {"partition_column": "RecordDate", "num_partitions": 4, "quote": '"'}}
    reader = jdbc_reader(spark, derby, parts)
    wm = T(2025, 1, 2, 3)
    df = reader(SPEC, watermark=wm).where(F.col("RecordDate") > F.lit(wm))
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 12 and len(sizes) == 4 and max(sizes) <= 4
    # full load without given bounds: split points asked from the source, and a range of nulls
    full = jdbc_reader(spark, derby, {"invoice_header": {"partition_column": "cust_num", "num_partitions": 3, "quote": '"'}})(SPEC)
    assert full.rdd.getNumPartitions() == 4 and full.count() == 40
    # end to end: the second (incremental) run reads through the watermark-aware reader
    lake = Lake(lake_root)
    ingest_table(spark, SPEC, lake, "2025-01-01-00", reader)
    synclog.reset_sync_state(spark, lake, "invoice_header")
    r = ingest_table(spark, SPEC, lake, "2025-01-01-01", reader)
    assert (r["mode"], r["rows_synced"]) == ("full", 40)
    r = ingest_table(spark, SPEC, lake, "2025-01-01-02", reader)
    assert (r["mode"], r["rows_synced"], r["skipped"]) == ("incremental", 0, True)


def _skewed(spark, src, n=900):
    """90 % of the dated rows in one hour, a third without a date, and one second that fills a fifth."""
    hour = T(2025, 3, 1, 12)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            at = None
        elif i % 10 == 1:
            at = T(2020, 1, 1) + dt.timedelta(days=i)
        elif i % 5 == 2:
            at = hour + dt.timedelta(minutes=30)
        else:
            at = hour + dt.timedelta(seconds=i * 3, microseconds=i)
        rows.append((f"INV{i:04}", i % 7, at))
    df = spark.createDataFrame(rows, "inv_num string, cust_num int, RecordDate timestamp")
    df.write.format("jdbc").option("url", src.url).option("dbtable", "skewed").option("driver", src.properties["driver"]) \
        .option("createTableColumnTypes", "inv_num VARCHAR(20)").mode("overwrite").save()
    return rows


def _sizes(df):
    return [len(p) for p in df.rdd.glom().collect()]


@pytest.mark.parametrize("n", [2, 8, 20])
def test_ranges_of_equal_depth(spark, derby, n):
    rows = _skewed(spark, derby)
    predicates = equi_depth_predicates(spark, derby, "APP.SKEWED", ["RecordDate", "inv_num"], n)
    df = jdbc_ranges(spark, derby, "APP.SKEWED", predicates)
    sizes = _sizes(df)
    assert len(sizes) == len(predicates) and max(sizes) <= 2 * len(rows) / n + 1
    assert sorted(r.inv_num for r in df.collect()) == [r[0] for r in rows]  # every row once, nulls too
    equal_width = jdbc_table(spark, derby, "APP.SKEWED", partition_column="RecordDate", num_partitions=n,
                             lower_bound="2020-01-01 00:00:00", upper_bound="2025-03-01 13:00:00")
    assert max(_sizes(equal_width)) > 2 * len(rows) / n or n == 2


def test_default_reads_are_split(spark, derby):
    from dataclasses import replace
    rows = _skewed(spark, derby)
    spec_ = TableSpec("SKEWED", "skewed", Pattern.INCREMENTAL, timestamp_column="RecordDate", keys=("inv_num",), schema="APP")
    df = jdbc_reader(spark, replace(derby, rows_per_range=100))(spec_)
    assert max(_sizes(df)) <= 200 and df.count() == len(rows) and len(_sizes(df)) >= 9
    assert len(_sizes(jdbc_reader(spark, derby)(spec_))) == 1  # few rows: one cursor
    by_key = TableSpec("SKEWED", "skewed", keys=("cust_num", "inv_num"), schema="APP")
    df = jdbc_reader(spark, replace(derby, rows_per_range=60))(by_key)  # seven values, each split by the second key
    assert max(_sizes(df)) <= 120 and sorted(r.inv_num for r in df.collect()) == [r[0] for r in rows]
    # a delta of the newest rows is split by itself
    above = T(2025, 3, 1, 12, 30)
    df = jdbc_reader(spark, replace(derby, rows_per_range=20))(spec_, watermark=above)
    from pyspark.sql import functions as F
    late = [r[0] for r in rows if r[2] and r[2] > above]
    part = df.where(F.col("RecordDate") > F.lit(above))
    assert sorted(r.inv_num for r in part.collect()) == late and max(_sizes(part)) <= 40 and len(late) > 100
    assert df.count() == len(rows)


def test_empty_table_and_odd_values(spark, derby):
    spark.createDataFrame([], "inv_num string, at date").write.format("jdbc").option("url", derby.url) \
        .option("dbtable", "nothing").option("driver", derby.properties["driver"]) \
        .option("createTableColumnTypes", "inv_num VARCHAR(20)").save()
    assert equi_depth_predicates(spark, derby, "APP.NOTHING", ["inv_num"], 4) == []
    odd = [("O'Neil", dt.date(2025, 1, 1)), ("x", dt.date(2025, 1, 2)), ("' OR 1 = 1", None), ("x", None), ("", None)]
    spark.createDataFrame(odd, "inv_num string, at date").write.format("jdbc").option("url", derby.url) \
        .option("dbtable", "odd").option("driver", derby.properties["driver"]) \
        .option("createTableColumnTypes", "inv_num VARCHAR(20)").save()
    for columns in (["inv_num", "at"], ["at", "inv_num"], ["at"]):
        df = jdbc_ranges(spark, derby, "APP.ODD", equi_depth_predicates(spark, derby, "APP.ODD", columns, 5))
        assert sorted(map(tuple, df.collect()), key=str) == sorted(odd, key=str)


def test_column_defaults_come_from_the_catalog(spark, derby):
    # What a column holds by default and whether it may be null, as the source declares it
    spark.createDataFrame([("a", 1, 2)], "code string, n int, m int").write.format("jdbc").option("url", derby.url) \
        .option("dbtable", "with_defaults").option("driver", derby.properties["driver"]) \
        .option("createTableColumnTypes", "code VARCHAR(50), n INT, m INT").save()
    jvm = spark.sparkContext._jvm
    connection = jvm.java.sql.DriverManager.getConnection(derby.url)
    connection.createStatement().execute("""ALTER TABLE with_defaults ALTER COLUMN "code" SET DEFAULT 'new'""")
    connection.createStatement().execute("""ALTER TABLE with_defaults ALTER COLUMN "n" NOT NULL""")
    connection.close()
    meta = source_schema(jdbc_table(spark, derby, "APP.WITH_DEFAULTS"), derby, "APP.WITH_DEFAULTS").collect()
    assert [(r.column_name, r.column_default, r.nullable, r.max_length) for r in meta] == [
        ("code", "'new'", True, 50), ("n", None, False, None), ("m", None, True, None)]


def test_ntile_form_of_the_quantile_query():
    import duckdb
    from lakestrata.sources.jdbc import NTILE_QUANTILES, quantiles_of
    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT CASE WHEN i % 4 > 0 THEN i END AS c FROM range(80) AS r(i)")
    got = con.sql(NTILE_QUANTILES.format(column="c", table="t", where="c IS NOT NULL", n=3, step=20)).fetchall()
    assert sorted(r[0] for r in got) == [26, 53, 79]
    assert quantiles_of("jdbc:sqlserver://h") == NTILE_QUANTILES and "ROW_NUMBER" in quantiles_of("jdbc:derby:memory:x")
