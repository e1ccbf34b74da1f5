"""Column expressions (2.3, 2.4, 2.10).

Everything here builds a ``Column`` from built-in functions, so it stays in
the JVM, inside whole-stage code generation, and can be pushed down where
Catalyst knows how.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = str | Column


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates -----------------------------------------------------------


def name_contains(c: ColumnLike, needle: str) -> Column:
    """Case-insensitive substring test (F4); ``%`` and ``_`` stand for themselves."""
    return F.contains(F.lower(col_of(c)), F.lit(needle.lower()))


def typed_literal(value: dt.datetime | dt.date | str, dtype: T.DataType) -> Column:
    """A literal of exactly ``dtype`` so that comparisons stay pushable."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, dt.date):
        text = value.isoformat()
    else:
        text = value
    return F.lit(text).cast(dtype)


def month_start(yyyymm: str) -> dt.datetime:
    return dt.datetime(int(yyyymm[:4]), int(yyyymm[4:6]), 1)


def next_month_start(yyyymm: str) -> dt.datetime:
    start = month_start(yyyymm)
    return dt.datetime(start.year + start.month // 12, start.month % 12 + 1, 1)


def month_range(
    c: ColumnLike, after_month: str, through_month: str, dtype: T.DataType = T.TimestampType()
) -> Column:
    """``after_month < yyyyMM(c) <= through_month`` as a half-open range.

    ``date_format(c, 'yyyyMM') > '201703'`` cannot reach the Parquet scan; the
    equivalent ``c >= 2017-04-01 AND c < 2018-12-01`` can (min/max row-group
    skipping, partition pruning on date-partitioned tables).
    """
    column = col_of(c)
    low = typed_literal(next_month_start(after_month), dtype)
    high = typed_literal(next_month_start(through_month), dtype)
    return (column >= low) & (column < high)


def month_equals(c: ColumnLike, yyyymm: str, dtype: T.DataType = T.TimestampType()) -> Column:
    """``date_format(c, 'MMyyyy') == '052018'`` as a pushable range."""
    column = col_of(c)
    return (column >= typed_literal(month_start(yyyymm), dtype)) & (
        column < typed_literal(next_month_start(yyyymm), dtype)
    )


def hour_between(c: ColumnLike, first: int | str, last: int | str) -> Column:
    """Hour of day in ``[first, last]`` (F8); equals the two-digit ``HH`` string test."""
    return F.hour(col_of(c)).between(int(first), int(last))


def day_range(
    c: ColumnLike, day: dt.date, dtype: T.DataType = T.TimestampType()
) -> Column:
    """``to_date(c) == day`` as a pushable range."""
    column = col_of(c)
    start = dt.datetime(day.year, day.month, day.day)
    return (column >= typed_literal(start, dtype)) & (
        column < typed_literal(start + dt.timedelta(days=1), dtype)
    )


def unix_day(seconds: int | str) -> dt.date:
    """The UTC calendar day of a Unix instant (the session zone is pinned to UTC)."""
    return dt.datetime.fromtimestamp(int(seconds), tz=dt.timezone.utc).date()


# --- value expressions ----------------------------------------------------


def clamp(c: ColumnLike, low: float, high: float) -> Column:
    """Below ``low`` → ``low``, above ``high`` → ``high``, null stays null."""
    column = col_of(c)
    return F.when(column < low, F.lit(low)).when(column > high, F.lit(high)).otherwise(column)


def scale_if(condition: Column, c: ColumnLike, factor: float) -> Column:
    """``c * factor`` where the condition holds, ``c`` otherwise (null condition too) (X11)."""
    column = col_of(c)
    return F.when(condition, column * factor).otherwise(column)


def flag_is(c: ColumnLike, value: str, if_true: int = 1, if_false: int = 0) -> Column:
    """1/0 encoding of ``c == value``; a null flag gets ``if_false``."""
    return F.when(col_of(c) == value, F.lit(if_true)).otherwise(F.lit(if_false))


# The date parts used as features, name → function.
DATE_PARTS: Mapping[str, Callable[[Column], Column]] = {
    "month": F.month,
    "day_of_week": F.dayofweek,
    "day_of_month": F.dayofmonth,
}


def date_parts(c: ColumnLike, parts: Mapping[str, Callable[[Column], Column]] = DATE_PARTS) -> dict[str, Column]:
    """Month, day of week (1 = Sunday) and day of month of ``c``."""
    column = col_of(c)
    return {name: fn(column) for name, fn in parts.items()}


# Fixed value: the long date format, e.g. "April 27, 1967".
LONG_DATE = "MMMM d, yyyy"


def format_date(c: ColumnLike, pattern: str = LONG_DATE) -> Column:
    """``date_format``."""
    return F.date_format(col_of(c), pattern)


def doubled_unix_date(c: ColumnLike) -> Column:
    """The date at twice the Unix time of ``c``."""
    return F.to_date(F.timestamp_seconds(F.unix_timestamp(col_of(c)) * 2))


def percent_text(part: ColumnLike, whole: ColumnLike, fmt: str = "%2.2f%%") -> Column:
    """``100 * part / whole`` as text with ``fmt`` (X12, X13); a zero whole gives null."""
    ratio = F.try_divide(col_of(part).cast("double") * 100.0, col_of(whole).cast("double"))
    # format_string would print a null as text ("n%"); keep it null instead.
    return F.when(ratio.isNotNull(), F.format_string(fmt, ratio))


def scaled_by_name_length(columns: Iterable[str]) -> list[Column]:
    """Each column times the length of its name, aliased ``"{c} * {len}"``."""
    return [(F.col(c) * len(c)).alias(f"{c} * {len(c)}") for c in columns]
