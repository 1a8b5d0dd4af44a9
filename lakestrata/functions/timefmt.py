"""Time helpers for partitions, watermarks and freshness."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITION_FORMAT = "yyyy-MM-dd-HH"          # lexicographic order == chronological order
PARTITION_PATTERN = r"^\d{4}-\d{2}-\d{2}-\d{2}$"
DEFAULT_WATERMARK = "1900-01-01"


def partition_of(ts: Column) -> Column:
    """The hour partition key 'YYYY-MM-DD-HH' of a timestamp."""
    return F.date_format(ts, PARTITION_FORMAT)


def watermark_literal(value: _dt.datetime | None, precision: str = "second") -> Column:
    """The watermark used in ``ts > watermark``.

    ``precision='second'`` truncates like the reference (rows in the boundary second
    are re-read: at-least-once); ``'microsecond'`` keeps the exact value.
    """
    if value is None:
        return F.lit(DEFAULT_WATERMARK).cast("timestamp_ntz")
    if precision == "second":
        value = value.replace(microsecond=0)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hours_between(earlier: Column, later: Column) -> Column:
    """Age in hours rounded to one decimal."""
    seconds = F.unix_timestamp(later.cast("timestamp")) - F.unix_timestamp(earlier.cast("timestamp"))
    return F.round(seconds / F.lit(3600.0), 1)
