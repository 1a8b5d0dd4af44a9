"""Relational sources over Spark's JDBC data source.

Table scans are lazy and parallel: unless bounds are given, a table is read in ranges of equal
depth. The source is asked for split points (quantiles of its timestamp or key column, one row a
range comes back) and each range becomes a ``predicates`` entry of its own, so a table whose rows
crowd into one hour, one value or null is still read evenly. Filters built as DataFrame
predicates (watermarks, ``spec.where``) are pushed into the source's WHERE clause by Catalyst, so
nothing is spliced into SQL text. Counts, samples and split points are sent as source-side
queries because the JDBC scan does not push aggregates or limits down.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections import Counter
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from lakestrata.specs import TableSpec, check_identifier

# Row count from the source's catalog statistics instead of a scan (SQL Server form, O(1),
# approximate like the statistics themselves); pass it as ``JdbcSource(count_template=...)``.
SQLSERVER_STATS_COUNT = ("SELECT SUM(row_count) AS n FROM sys.dm_db_partition_stats "
                         "WHERE object_id = OBJECT_ID('{qualified}') AND index_id IN (0, 1)")

# Greatest value of each of {n} ranges of equal depth; the second form is for sources without NTILE.
NTILE_QUANTILES = ("SELECT MAX(v) AS hi FROM (SELECT {column} AS v, NTILE({n}) OVER (ORDER BY {column}) AS tile "
                   "FROM {table} WHERE {where}) t GROUP BY tile")
ROW_NUMBER_QUANTILES = ("SELECT v AS hi FROM (SELECT v, ROW_NUMBER() OVER () AS rn FROM (SELECT {column} AS v "
                        "FROM {table} WHERE {where} ORDER BY {column}) s) t WHERE MOD(rn, {step}) = 0")


def quantiles_of(url: str) -> str:
    """The form of the quantile query that the source at ``url`` understands."""
    return ROW_NUMBER_QUANTILES if url.startswith("jdbc:derby:") else NTILE_QUANTILES


@dataclass(frozen=True)
class JdbcSource:
    url: str
    properties: dict = field(default_factory=dict)   # user, password, driver, ...
    fetchsize: int = 10_000
    query_timeout_s: int = 0                          # 0 = no limit
    limit_template: str = "SELECT TOP {n} * FROM {table}"  # SQL Server; Derby: FETCH FIRST
    count_template: str = "SELECT COUNT(*) AS n FROM {qualified}"  # or SQLSERVER_STATS_COUNT
    quantile_template: str = NTILE_QUANTILES         # or ROW_NUMBER_QUANTILES
    quote: str = ""                                   # of column names in split queries, e.g. '"'
    rows_per_range: int = 1_000_000                   # rows that one cursor of a default split fetches
    max_ranges: int = 1024

    def _reader(self, spark: SparkSession):
        r = (spark.read.format("jdbc").option("url", self.url).option("fetchsize", self.fetchsize)
             .option("queryTimeout", self.query_timeout_s))
        for k, v in self.properties.items():
            r = r.option(k, v)
        return r


def jdbc_table(spark: SparkSession, src: JdbcSource, table: str, *, partition_column: str | None = None,
               lower_bound=None, upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """A source table as a lazily scanned DataFrame (optionally range-partitioned)."""
    r = src._reader(spark).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", num_partitions or 8))
    return r.load()


def _literal(value) -> str:
    """A value that the source returned, as SQL text (JDBC escapes for dates and times)."""
    if isinstance(value, _dt.datetime):
        return "{ts '" + value.isoformat(" ", "microseconds") + "'}"
    if isinstance(value, _dt.date):
        return "{d '" + value.isoformat() + "'}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"no range reads over {type(value).__name__} columns")


def _source_rows(spark: SparkSession, src: JdbcSource, query: str) -> list:
    """The rows of a small source-side query; times as the source's wall clock."""
    return src._reader(spark).option("preferTimestampNTZ", True).option("query", query).load().collect()


def _quantiles(spark: SparkSession, src: JdbcSource, table: str, column: str, where: str, n: int, rows: int) -> list:
    query = src.quantile_template.format(column=column, table=table, where=where, n=n, step=-(-rows // n))
    return sorted(r[0] for r in _source_rows(spark, src, query) if r[0] is not None)[:n]


def _ranges(spark: SparkSession, src: JdbcSource, table: str, columns: list[str], where: str | None, n: int,
            rows: int) -> list[str]:
    """Predicates that part the rows of ``where`` without overlap into about ``n`` ranges of equal depth.

    A value that fills several ranges, null among them, is split again by the next column. They cover every
    row whatever the split points are, also rows that arrive after these were taken.
    """
    def and_(*terms: str | None) -> str:
        return " AND ".join(f"({t})" for t in terms if t) or "1 = 1"

    if n <= 1 or not columns:
        return [and_(where)]
    c = columns[0]
    known = _source_rows(spark, src, f"SELECT COUNT({c}) AS k, COUNT(*) AS n FROM {table} WHERE {and_(where)}")[0]
    have, nulls = int(known[0]), int(known[1]) - int(known[0])
    depth = max(1, -(-rows // n))
    out, low = [], None
    tiles = -(-have // depth)
    highs = _quantiles(spark, src, table, c, and_(where, f"{c} IS NOT NULL"), tiles, have) if have else []
    if len(highs) >= tiles and highs[-1:] != highs[-2:-1]:
        highs.pop()  # the last range is open above
    for value, times in Counter(highs).items():
        at, above = _literal(value), f"{c} > {low}" if low else None
        if times > 1:  # a hot value: what is below it, then the value by the next column
            out.append(and_(where, above, f"{c} < {at}"))
            out += _ranges(spark, src, table, columns[1:], and_(where, f"{c} = {at}"), times, times * depth)
        else:
            out.append(and_(where, above, f"{c} <= {at}"))
        low = at
    out.append(and_(where, f"{c} > {low}" if low else f"{c} IS NOT NULL"))
    return out + _ranges(spark, src, table, columns[1:], and_(where, f"{c} IS NULL"), -(-nulls // depth), nulls)


def equi_depth_predicates(spark: SparkSession, src: JdbcSource, table: str, columns: list[str],
                          num_partitions: int | None = None, above: _dt.datetime | None = None) -> list[str]:
    """Predicates of ranges of equal depth over ``columns`` (the first splits, the next split its
    hot values and nulls). ``above`` weighs only rows whose first column is greater: an incremental read's delta.

    Without ``num_partitions`` there are as many ranges as give ``src.rows_per_range`` rows each; an empty
    list means that one cursor is enough.
    """
    table = qualified_name(table)
    quoted = [f"{src.quote}{check_identifier(c)}{src.quote}" for c in columns]
    delta = f"{quoted[0]} > {_literal(above)}" if above is not None else None
    rows = int(_source_rows(spark, src, f"SELECT COUNT(*) AS n FROM {table}" + (f" WHERE {delta}" if delta else ""))[0][0])
    n = num_partitions or min(src.max_ranges, -(-rows // src.rows_per_range))
    if n <= 1 or rows == 0:
        return []
    if delta is None:
        return _ranges(spark, src, table, quoted, None, n, rows)
    inside = _ranges(spark, src, table, quoted[:1], delta, n, rows)
    return [f"NOT ({delta}) OR {quoted[0]} IS NULL", *inside[:-1]]


# Source types that a source does not order by (fixed values of the dialects).
_UNORDERED = {"clob", "nclob", "dbclob", "text", "ntext", "xml", "blob", "image", "json"}


def _orderable(df: DataFrame, column: str) -> bool:
    field_ = {f.name.lower(): f for f in df.schema.fields}.get(column.lower())
    if field_ is None or not isinstance(field_.dataType, (NumericType, StringType, DateType, TimestampType, TimestampNTZType)):
        return False
    return str((field_.metadata or {}).get("jdbcClientType", "")).lower() not in _UNORDERED


def jdbc_ranges(spark: SparkSession, src: JdbcSource, table: str, predicates: list[str]) -> DataFrame:
    """A source table read by one query per predicate."""
    options = {**src.properties, "fetchsize": str(src.fetchsize), "queryTimeout": str(src.query_timeout_s)}
    return spark.read.jdbc(src.url, table, predicates=predicates, properties={k: str(v) for k, v in options.items()})


def range_partitioning(spark: SparkSession, src: JdbcSource, table: str, column: str,
                       num_partitions: int, quote: str = "") -> dict:
    """Bounds for a parallel read, asked from the source (one MIN/MAX row comes back).

    The result feeds :func:`jdbc_table` / :func:`jdbc_reader`: Spark then issues
    ``num_partitions`` range queries on ``column`` (numeric, date or timestamp) instead of
    one cursor. Rows outside the bounds are still read (first / last range are open).
    """
    table = qualified_name(table)
    c = f"{quote}{check_identifier(column)}{quote}"
    row = jdbc_query(spark, src, f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {table}").first()
    if row is None or row[0] is None:
        return {}
    return {"partition_column": column, "lower_bound": row[0], "upper_bound": row[1],
            "num_partitions": num_partitions}


def jdbc_reader(spark: SparkSession, src: JdbcSource, partitioning: dict | None = None):
    """A ``Reader`` for ingestion: (TableSpec, watermark) -> DataFrame over ``schema.table``.

    Tables are read in ranges of equal depth over their timestamp column, or else their keys. When the run has
    a watermark, the ranges part its delta; rows up to the watermark are one range more, which the pushed
    watermark filter leaves without a row. ``partitioning`` maps target tables to
    ``dict(partition_column=..., num_partitions=...)`` to choose column and number, or with ``lower_bound`` and
    ``upper_bound`` to Spark's ranges of equal width.
    """
    def read(spec: TableSpec, watermark: _dt.datetime | None = None) -> DataFrame:
        opts = dict((partitioning or {}).get(spec.target_table, {}))
        if "lower_bound" in opts and "upper_bound" in opts:
            opts.pop("quote", None)
            return jdbc_table(spark, src, spec.full_source_name, **opts)
        source = replace(src, quote=opts.get("quote", src.quote))
        first = opts.get("partition_column") or spec.timestamp_column or (spec.keys[0] if spec.keys else None)
        plain = jdbc_table(spark, src, spec.full_source_name)
        columns = [c for c in dict.fromkeys([first, *spec.keys]) if c and _orderable(plain, c)]
        if not columns:
            return plain
        above = watermark if columns[0] == spec.timestamp_column else None
        predicates = equi_depth_predicates(spark, source, spec.full_source_name, columns, opts.get("num_partitions"), above)
        if not predicates:
            return plain
        return jdbc_ranges(spark, src, spec.full_source_name, predicates)
    return read


def jdbc_query(spark: SparkSession, src: JdbcSource, query: str) -> DataFrame:
    """An ad-hoc source query (runs at the source, result read as a DataFrame)."""
    return src._reader(spark).option("query", query).load()


def qualified_name(table: str, schema: str | None = None) -> str:
    """``[db.]schema.table`` with every part validated whole (nothing else is spliced into SQL)."""
    parts = ([schema] if schema else []) + table.split(".")
    return ".".join(check_identifier(x) for x in parts)


def source_row_count(spark: SparkSession, src: JdbcSource, table: str, schema: str | None = None) -> int:
    """Row count computed by the source (one row comes back; 0 when it has none).

    ``src.count_template`` decides how: a ``COUNT(*)`` by default, or the catalog
    statistics (``SQLSERVER_STATS_COUNT``), which answer without scanning the table.
    """
    name = qualified_name(table, schema)
    part_schema, _, part_table = name.rpartition(".")
    query = src.count_template.format(qualified=name, schema=part_schema, table=part_table)
    row = jdbc_query(spark, src, query).first()
    return int(row[0]) if row is not None and row[0] is not None else 0


def source_sample(spark: SparkSession, src: JdbcSource, table: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows the source returns (limit applied at the source)."""
    return jdbc_query(spark, src, src.limit_template.format(n=int(n), table=qualified_name(table)))


_SCHEMA_ROWS = ("ordinal int, column_name string, data_type string, max_length int, nullable boolean, "
                "column_default string, spark_type string")
_LENGTH = re.compile(r"^(?:var)?char\((\d+)\)$")


def catalog_columns(spark: SparkSession, src: JdbcSource, table: str) -> dict[str, tuple[str | None, bool | None]]:
    """Column -> (default expression, nullable) from the source's JDBC catalog (``DatabaseMetaData``).

    Asked over a connection that Spark's own dialect opens on the driver. Metadata only.
    """
    jvm = spark.sparkContext._jvm
    options = jvm.java.util.HashMap()
    for k, v in {**src.properties, "url": src.url, "dbtable": table}.items():
        options.put(k, str(v))
    parsed = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(jvm.PythonUtils.toScalaMap(options))
    connection = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(src.url).createConnectionFactory(parsed).apply(-1)
    try:
        schema, _, name = qualified_name(table).rpartition(".")
        found = connection.getMetaData().getColumns(None, schema.rpartition(".")[2] or None, name, None)
        out = {}
        while found.next():
            nullable = {0: False, 1: True}.get(found.getInt("NULLABLE"))
            out[found.getString("COLUMN_NAME")] = (found.getString("COLUMN_DEF"), nullable)
        return out
    finally:
        connection.close()


def source_schema(df: DataFrame, src: JdbcSource | None = None, table: str | None = None) -> DataFrame:
    """Column metadata in ordinal order: name, source type, max length, nullable, default.

    For a JDBC source the source type and declared length come from the field metadata
    Spark's JDBC reader records (``jdbcClientType``, ``varchar(n)``); for other sources the
    Spark type stands in. With ``src`` and ``table`` the source's catalog adds what columns
    allow and hold by default. Metadata only: no data is read.
    """
    catalog = catalog_columns(df.sparkSession, src, table) if src is not None else {}
    rows = []
    for i, f in enumerate(df.schema.fields):
        meta = f.metadata or {}
        declared = str(meta.get("__CHAR_VARCHAR_TYPE_STRING", ""))
        m = _LENGTH.match(declared)
        default, nullable = catalog.get(f.name, (None, None))
        rows.append({"ordinal": i + 1, "column_name": f.name,
                     "data_type": str(meta.get("jdbcClientType", f.dataType.simpleString())).lower(),
                     "max_length": int(m.group(1)) if m else None,
                     "nullable": bool(f.nullable) if nullable is None else nullable,
                     "column_default": default, "spark_type": f.dataType.simpleString()})
    return df.sparkSession.createDataFrame(rows, _SCHEMA_ROWS)


def frame_reader(frames: dict[str, DataFrame]):
    """A ``Reader`` over ready DataFrames keyed by target table (tests, file sources)."""
    def read(spec: TableSpec) -> DataFrame:
        return frames[spec.target_table]
    return read


def count_rows(df: DataFrame) -> DataFrame:
    """S7 for file/catalog sources: the count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
