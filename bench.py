"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is fully materialised through the ``noop`` sink (every row computed, nothing
collected to the driver). Every query is run once untimed (JVM / code-generation warm-up),
then the reported time is the median of $BENCH_REPEAT timed runs and ``spread`` has the least and the
greatest (steady state, which is what matters for long jobs at scale). ``ingest_incremental_1pct`` times
an incremental bronze load whose delta is the newest ~1 % of invoice lines (after a full load of the other
99 %), each into a fresh lake after one untimed warm-up pass.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakestrata.plans.ingest import ingest_table  # noqa: E402
from lakestrata.plans.lake import Lake  # noqa: E402
from lakestrata.queries import QUERIES  # noqa: E402
from lakestrata.session import get_session, local_scratch  # noqa: E402
from lakestrata.sources.fixtures import load  # noqa: E402
from lakestrata.specs import spec  # noqa: E402

HEADLINE = ["margin_invoice", "fact_invoice", "margin_rebate", "sales_by_region", "sales_by_product",
            "fact_general_ledger", "fact_order_item", "sales_rollup", "current_by_key", "bronze_audit"]


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> list[float]:
    took = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        took.append(round(time.perf_counter() - t0, 3))
    return took


def bench_incremental(spark, sf_dir: str, scratch: str) -> tuple[float, float]:
    item = spec("invoice_item")
    source = load(spark, sf_dir, "invoice_item")
    cut = source.agg(F.percentile_approx(F.col("RecordDate").cast("timestamp").cast("long"), 0.99)
                     .alias("p")).first().p
    cut_ts = F.lit(cut).cast("timestamp").cast("timestamp_ntz")
    lake = Lake(scratch)
    t0 = time.perf_counter()
    ingest_table(spark, item, lake, "2001-09-01-00", lambda s: source.where(F.col("RecordDate") <= cut_ts))
    full = time.perf_counter() - t0
    t0 = time.perf_counter()
    res = ingest_table(spark, item, lake, "2001-09-01-01", lambda s: source)
    inc = time.perf_counter() - t0
    assert res["mode"] == "incremental", res
    return round(full, 3), round(inc, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", "lakestrata-bench", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": "16g"})
    materialise(QUERIES["sales_by_region"](spark, sf_dir))  # warm-up (JVM, file listing)
    runs = {}
    for name in HEADLINE:
        materialise(QUERIES[name](spark, sf_dir))  # warm-up, untimed
        runs[name] = timed(lambda: materialise(QUERIES[name](spark, sf_dir)), repeat)
    scratch = spark.conf.get("spark.checkpoint.dir", None) or local_scratch(spark.sparkContext.master)
    scratch = scratch.rstrip("/") + f"/bench-{int(time.time())}"
    bench_incremental(spark, sf_dir, scratch + "-warmup")  # warm-up into its own lake, untimed
    loads = [bench_incremental(spark, sf_dir, f"{scratch}-{k}") for k in range(repeat)]
    runs["ingest_full_99pct"], runs["ingest_incremental_1pct"] = map(list, zip(*loads))
    results = {name: statistics.median(took) for name, took in runs.items()}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "spread": {n: [min(t), max(t)] for n, t in runs.items()}, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
