"""Coercions of dirty bronze text into typed values.

Bronze columns arrive as text (the JSON hop drops types), so every reader re-types
them. ANSI mode stays on: every cast here is a ``try_cast`` so bad input becomes null
(or 0 where the business rule says so) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MONEY = "decimal(18,4)"       # client money / quantities
PRODUCT = "decimal(33,4)"     # quantity times money: wide enough for any two MONEY values
SALES_MONEY = "decimal(18,2)"  # ERP sales money

# Whitespace as Python's str.strip() sees it: every code point for which str.isspace() holds
# (all of them lie below U+3001).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# A leading calendar date; guards try_cast against time-only strings such as '10:30'.
_ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"

_MONTHS = "january february march april may june july august september october november december".split()
_NAMED = "(?=(?:" + "|".join(f"{m}|{m[:3]}" for m in _MONTHS) + ")(?![a-z]))"
# Layouts accepted besides ISO-8601, as the reference parser reads them: each step turns one of them, in lower
# case with single spaces, into year, month or its name, day and a time of day, which one format then reads.
# Two-digit years from 69 on are 19xx. One chain without repeats keeps the generated code small.
_STEPS = (
    (r"^(\d{4})(\d{2})(\d{2})(?=$|[t ])", "$1-$2-$3"), (r"(?<=^\d{4}-\d{2}-\d{2})[t ](\d{2})(\d{2})$", " $1:$2"),
    (r"(?<=^\d{4}-\d{2}-\d{2})[t ](\d{2})(\d{2})(\d{2})$", " $1:$2:$3"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(?=$|[t ])", "$1-$2-$3"),
    (rf"^{_NAMED}([a-z]{{3}})[a-z]*\.? (\d{{1,2}}) (\d{{4}})(?=$|[t ])", "$3-$1-$2"),
    (rf"^(\d{{1,2}})([- ]){_NAMED}([a-z]{{3}})[a-z]*\.?[- ](\d{{4}}|\d{{2}})(?=$|[t ])", "$1-$3-$4"),
    (r"^(\d{1,2}[-/.])(\d{1,2}|[a-z]{3})[-/.](?=[0-6]\d(?:$|[t ]))(?!69)", "$1$2-20"),
    (r"^(\d{1,2}[-/.])(\d{1,2}|[a-z]{3})[-/.](?=\d\d(?:$|[t ]))", "$1$2-19"),
    (r"^(1[3-9]|2\d|3[01]|\d{1,2}(?=-[a-z]))[-/.](\d{1,2}|[a-z]{3})[-/.](\d{4})(?=$|[t ])", "$3-$2-$1"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?=$|[t ])", "$3-$1-$2"),
    (r"(?<=\d) (am|pm)$", "$1"), (r"(?<=\d)t(?=\d)", " "),
)
_LAYOUT = "yyyy-[MMM][M]-d[ h:mm[:ss]a][ H:mm[:ss[.SSSSSSSSS]]]"


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column if the frame has it, else a typed null (decided at plan time)."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)


def strip_ws(c: Column) -> Column:
    """Trim leading/trailing whitespace (tabs, newlines, Unicode spaces); null stays null."""
    return F.trim(c.cast(StringType()), F.lit(WHITESPACE))


def to_decimal_or_null(c: Column, dtype: str = MONEY) -> Column:
    """M2 for money: text -> decimal; anything unparsable -> null."""
    return _try_cast(c, dtype)


def to_decimal_or_zero(c: Column, dtype: str = MONEY) -> Column:
    """M1: text -> decimal; unparsable or missing -> 0.

    ' 12 ' -> 12, '1e3' -> 1000, '1,000' / '0x10' / 'abc' / '' / null -> 0.
    """
    return F.coalesce(_try_cast(c, dtype), F.lit(0).cast(dtype))


def to_int_or_null(c: Column) -> Column:
    """M2: text -> INT, unparsable -> null (not filled)."""
    return _try_cast(c, "int")


def parse_timestamp(c: Column) -> Column:
    """Mixed-format text -> TIMESTAMP_NTZ, unparsable -> null.

    Accepts ISO dates and date-times (space or 'T', fractional seconds), and besides them year, month, day parted
    by '-', '/' or '.'; month, day, year likewise (day first only where the first number cannot be a month), with
    four or two digits of the year; 'yyyyMMdd', also with 'THHmm[ss]'; and month names, short or whole, before or
    behind the day. Each but the compact form may be followed by a time of day of 24 hours, or of 12 with AM or PM.
    Commas and runs of spaces count as one space. A bare time such as '10:30' is rejected. A UTC offset is
    not applied: the result is the clock time as written, which is also what its date is taken from.
    """
    text = c.cast(StringType())
    iso = F.when(text.rlike(_ISO_DATE), _try_cast(F.trim(text), "timestamp_ntz"))
    plain = F.trim(F.lower(F.regexp_replace(text, r"[,\s]+", " ")))
    for pattern, parts in _STEPS:
        plain = F.regexp_replace(plain, pattern, parts)
    return F.coalesce(iso, F.try_to_timestamp(plain, F.lit(_LAYOUT)).cast("timestamp_ntz"))


def id_from_text(c: Column) -> Column:
    """An id stored as text, possibly float-formatted ('1008.0') or '' -> INT."""
    return _try_cast(_try_cast(F.nullif(strip_ws(c), F.lit("")), "decimal(10,0)"), "int")


def _try_cast(c: Column, dtype: str) -> Column:
    return c.try_cast(dtype)
