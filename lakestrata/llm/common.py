"""Helpers the training-data operators share: word rules, stored tables, row numbers, folds."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.plans.lake import _fs
from lakestrata.session import shared_dir

#: A word is a run of characters outside this class; ``bytes.split()`` splits on exactly the same set.
SPACE = r"\x20\x09-\x0D"
ROW = "__row"
BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SAVED: list[str] = []


def save(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table into the folder that driver and executors share and read it back.

    Cuts the lineage: a lost executor only re-runs tasks of what comes after.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _SAVED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def saved() -> int:
    """A mark for discard(): the number of tables that save() has stored so far."""
    return len(_SAVED)


def discard(spark: SparkSession, since: int) -> None:
    """Delete the tables that were stored from the mark ``since`` on, but for the last one.

    For a caller that has just stored its result and so needs nothing that it was made of any more.
    """
    for path in _SAVED[since:-1]:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    del _SAVED[since:-1]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def named(column: str) -> Column:
    """The column of just this name, whatever dots or quotes are in it."""
    return F.col("`" + column.replace("`", "``") + "`")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number in ROW. The numbers hang on how a scan is split, so they hold for one
    evaluation only: whoever needs them twice stores them, see stored_rows()."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def stored_rows(docs: DataFrame) -> DataFrame:
    """ROW and ``__doc``, a struct of all columns, so nothing that is joined to it clashes with them.

    Numbered once and stored with the numbers: what is decided by ROW and the rows it is decided about are
    both read from this table.
    """
    inside = [named(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    rows = docs.select(F.struct(*inside).alias("__doc")).withColumn(ROW, F.monotonically_increasing_id())
    return save(rows, "rows", compression="zstd")


def fields(rows: DataFrame, columns: list[str], *names: str) -> DataFrame:
    """ROW and the columns ``names`` of the stored_rows() of a table with ``columns``."""
    places = [c.lower() for c in columns]
    return rows.select(ROW, *[F.col(f"__doc.c{places.index(n)}").alias(n) for n in names])


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that stored_rows() put into ``__doc``."""
    return rows.select(*[F.col(f"__doc.c{k}").alias(c) for k, c in enumerate(columns)])


def words(text: Column) -> Column:
    """Array of the words of a text; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), f"[{SPACE}]+"), "")


def without_space(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{SPACE}]+", "")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it inside higher-order lambdas without evaluating it per element."""
    return F.transform(F.array(value), body)[0]


def as_bytes(column) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null becomes empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a whole text in lists of about ``size`` bytes, so that a very long text stays bounded."""
    if len(data) <= size:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        if end < len(data):
            hit = _SPACE.search(data, end)
            end = hit.start() if hit else len(data)
        yield data[start:end].split()
        start = end


def small_batches(batches, rows: int = 512):
    """Arrow batches cut to few rows, so the Python objects made of one batch stay small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
