"""Command-line jobs, one per flow of the reproduced pipelines, for ``spark-submit``.

Scheduling stays outside (any scheduler calls these on its cadence)::

    spark-submit lakestrata/jobs.py ingest      --lake URI --jdbc-url URL [--jdbc-user U]
                 [--jdbc-password-env VAR] [--jdbc-driver CLASS] [--tables a,b] [--domain D] [--full-refresh]
                 [--partition YYYY-MM-DD-HH] [--partition-value V] [--parallel TABLE=COLUMN:N ...]
                 [--rows-per-range N] [--identifier-quote Q]
    spark-submit lakestrata/jobs.py build-gold  --lake URI [--tables a,b] [--scope latest|current]
                 [--as-of YYYY-MM-DD]
    spark-submit lakestrata/jobs.py sales-flow  --lake URI --partition P [--report-date D]
    spark-submit lakestrata/jobs.py sales-stream --lake URI [--report-date D]
    spark-submit lakestrata/jobs.py verify      --lake URI [--tables a,b] [--max-age-hours 24]
    spark-submit lakestrata/jobs.py views       --lake URI [--views a,b] [--scope all|latest]
    spark-submit lakestrata/jobs.py compact-ops --lake URI --before-month YYYY-MM
    spark-submit lakestrata/jobs.py vacuum-bronze --lake URI [--tables a,b] [--retention-hours 24]

Each job prints one JSON line with its result. The JDBC password is read from an
environment variable, never from the command line.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import sys
from typing import Sequence

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakestrata.plans.current import vacuum_current  # noqa: E402
from lakestrata.plans.gold import build_gold  # noqa: E402
from lakestrata.plans.ingest import hour_partition, ingest_all, snapshot_sync_log  # noqa: E402
from lakestrata.plans.lake import Lake, compact_ops, lake_bytes  # noqa: E402
from lakestrata.plans.sales_flow import run_sales_flow  # noqa: E402
from lakestrata.plans.verify import vacuum_bronze, verification_report  # noqa: E402
from lakestrata.plans.views import create_views, sample_views  # noqa: E402
from lakestrata.session import get_session, sizing  # noqa: E402
from lakestrata.sources.jdbc import JdbcSource, jdbc_reader, quantiles_of  # noqa: E402
from lakestrata.specs import CLIENT_TABLES, tables_by_domain  # noqa: E402
from lakestrata.streaming.sales_stream import run_available_now  # noqa: E402


def _tables(value: str | None) -> list[str] | None:
    return [t.strip() for t in value.split(",") if t.strip()] if value else None


def _jsonable(value):
    if isinstance(value, (_dt.datetime, _dt.date)):
        return value.isoformat()
    if isinstance(value, dict):
        return {k: _jsonable(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_jsonable(v) for v in value]
    return value


def parallel_reads(specs: Sequence[str]) -> dict:
    """``TABLE=COLUMN:N`` options -> the ``partitioning`` map of :func:`jdbc_reader`."""
    out = {}
    for item in specs:
        table, _, rest = item.partition("=")
        column, _, n = rest.partition(":")
        if not (table and column and n.isdigit() and int(n) > 0):
            raise ValueError(f"--parallel expects TABLE=COLUMN:N, got {item!r}")
        out[table] = {"partition_column": column, "num_partitions": int(n)}
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakestrata.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    ing = sub.add_parser("ingest", help="source tables -> bronze (+ sync log, lineage)")
    ing.add_argument("--jdbc-url", required=True)
    ing.add_argument("--jdbc-user")
    ing.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    ing.add_argument("--jdbc-driver")
    ing.add_argument("--full-refresh", action="store_true")
    ing.add_argument("--domain", help="only the tables of this domain")
    ing.add_argument("--partition", help="bronze partition (default: the current UTC hour)")
    ing.add_argument("--partition-value", help="value that date-partition tables load")
    ing.add_argument("--identifier-quote", default="", help="quote for column names in split queries, e.g. '\"'")
    ing.add_argument("--rows-per-range", type=int, default=1_000_000,
                     help="rows that one source cursor fetches; bigger tables are read in ranges of equal depth")
    ing.add_argument("--parallel", action="append", default=[], metavar="TABLE=COLUMN:N",
                     help="read TABLE in N ranges of equal depth on COLUMN (of the delta when COLUMN "
                          "is the table's timestamp); repeatable")

    gold = sub.add_parser("build-gold", help="bronze -> gold facts, dimension and margin tables")
    gold.add_argument("--scope", choices=("latest", "current"), default="current")
    gold.add_argument("--as-of", help="rebate cutoff reference date (default: today)")

    flow = sub.add_parser("sales-flow", help="one bronze sales partition -> silver -> gold")
    flow.add_argument("--partition", required=True)
    flow.add_argument("--report-date")

    stream = sub.add_parser("sales-stream", help="process every arrived bronze sales file once")
    stream.add_argument("--report-date")
    stream.add_argument("--max-files-per-trigger", type=int, default=10_000,
                        help="files per micro-batch (a backlog drains in bounded batches)")

    ver = sub.add_parser("verify", help="sync summary, stale tables, table state, bronze audit")
    ver.add_argument("--max-age-hours", type=int, default=24)

    comp = sub.add_parser("compact-ops", help="rewrite closed months of the ops tables and fold those of the sync log")
    comp.add_argument("--before-month", required=True)

    views = sub.add_parser("views", help="create the typed serving views and sample each (publish check)")
    views.add_argument("--views", help="comma-separated view names (default: all)")
    views.add_argument("--scope", choices=("all", "latest"), default="all")
    views.add_argument("--session-only", action="store_true", help="do not create the views in the catalog")

    vac = sub.add_parser("vacuum-bronze", help="delete old batch folders no reader sees any more")
    vac.add_argument("--retention-hours", type=float, default=24)

    for s in (ing, gold, flow, stream, ver, comp, vac, views):
        s.add_argument("--lake", required=True, help="lake root URI (any Hadoop filesystem)")
    for s in (ing, gold, ver, vac):
        s.add_argument("--tables", help="comma-separated table names (default: all)")
    for s in (ing, gold):
        s.add_argument("--max-parallel", type=int, default=4, help="tables run as concurrent jobs")
    return p


def run(args: argparse.Namespace, spark=None) -> dict:
    spark = spark or get_session(app_name=f"lakestrata-{args.job}")
    lake = Lake(args.lake)
    if not spark.sparkContext.master.startswith("local"):  # the plans shuffle what the lake holds
        stored = lake_bytes(spark, lake)
        for key, value in sizing(stored, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    if args.job == "ingest":
        props = {}
        if args.jdbc_user:
            props["user"] = args.jdbc_user
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        partition = args.partition or hour_partition(_dt.datetime.now(_dt.timezone.utc))
        source = JdbcSource(args.jdbc_url, props, quote=args.identifier_quote, rows_per_range=args.rows_per_range,
                            quantile_template=quantiles_of(args.jdbc_url))
        reader = jdbc_reader(spark, source, parallel_reads(args.parallel))
        specs = tables_by_domain(args.domain) if args.domain else CLIENT_TABLES
        res = ingest_all(spark, specs, lake, partition, reader, tables=_tables(args.tables),
                         force_full=args.full_refresh, max_parallel=args.max_parallel,
                         partition_value=args.partition_value)
        return {"job": "ingest", "partition": partition, "tables": [r.asDict() for r in res.collect()]}
    if args.job == "build-gold":
        out = build_gold(spark, lake, _tables(args.tables), scope=args.scope, as_of=args.as_of,
                         max_parallel=args.max_parallel)
        return {"job": "build-gold", "tables": {k: {"partition": v.partition, "rows": v.rows} for k, v in out.items()}}
    if args.job == "sales-flow":
        return {"job": "sales-flow", **run_sales_flow(spark, lake, args.partition, report_date=args.report_date)}
    if args.job == "sales-stream":
        run_available_now(spark, lake, report_date=args.report_date,
                          max_files_per_trigger=args.max_files_per_trigger)
        return {"job": "sales-stream", "status": "caught up"}
    if args.job == "verify":
        # the report grows with the partitions audited: it is written to the lake, and only
        # a bounded summary (per section, stale tables, failing partitions) comes back
        stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        path = f"{lake.root.rstrip('/')}/_ops/reports/verification/run={stamp}"
        verification_report(spark, lake, _tables(args.tables), max_age_hours=args.max_age_hours) \
            .write.mode("overwrite").parquet(path)
        report = spark.read.parquet(path)
        by_section = {r.section: r["count"] for r in report.groupBy("section").count().collect()}
        stale = sorted({r.table for r in report.where("section = 'stale'").select("table").collect()})
        failing = report.where("section = 'bronze_audit' AND metric = 'status' AND value <> 'OK'").count()
        return {"job": "verify", "report_path": path, "rows_by_section": by_section,
                "stale_tables": stale, "bronze_partitions_not_ok": failing}
    if args.job == "views":
        # created in the catalog, where other sessions of its metastore query them; the job checks that
        # every view resolves and its typed casts run, counting a 5-row sample of each
        status = create_views(spark, lake, _tables(args.views), scope=args.scope, persistent=not args.session_only)
        created = [v for v, st in status.items() if st == "created"]
        if failed := {v: st for v, st in status.items() if st.startswith("error: ")}:  # the others are in place
            raise RuntimeError(f"views not created: {failed}")
        samples = {v: df.count() for v, df in sample_views(spark, created, 5).items()}
        return {"job": "views", "views": {v: {"status": st, "sample_rows": samples.get(v)} for v, st in status.items()}}
    if args.job == "compact-ops":
        return {"job": "compact-ops", "compacted": compact_ops(spark, lake, args.before_month),
                "snapshot": snapshot_sync_log(spark, lake, args.before_month)}
    if args.job == "vacuum-bronze":
        names = _tables(args.tables) or [s.target_table for s in CLIENT_TABLES]
        return {"job": "vacuum-bronze",
                "dropped": {t: len(vacuum_bronze(spark, lake, t, args.retention_hours)) for t in names},
                "dropped_state": {t: len(vacuum_current(spark, lake, t, args.retention_hours)) for t in names}}
    raise ValueError(args.job)


def main(argv: Sequence[str] | None = None, spark=None) -> dict:
    result = _jsonable(run(parser().parse_args(argv), spark))
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
