"""Row filters (2.4).  Every one is ``fn(df, ...) -> DataFrame``.

Time filters are written as ranges on the raw column, typed like the column,
so that Parquet min/max statistics and partition pruning apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.columns import (
    day_range,
    hour_between,
    month_equals,
    month_range,
    unix_day,
)


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


def limit_history(
    df: DataFrame, ts_col: str, after_month: str = "201703", through_month: str = "201811"
) -> DataFrame:
    """Keep rows with ``after_month < yyyyMM(ts) <= through_month``."""
    return df.filter(month_range(ts_col, after_month, through_month, _dtype(df, ts_col)))


def in_month(df: DataFrame, ts_col: str, yyyymm: str) -> DataFrame:
    """Keep rows of one calendar month."""
    return df.filter(month_equals(ts_col, yyyymm, _dtype(df, ts_col)))


def keep_hours(df: DataFrame, ts_col: str, first: int | str = 17, last: int | str = 23) -> DataFrame:
    """Keep rows whose hour of day lies in ``[first, last]`` (F8)."""
    return df.filter(hour_between(ts_col, first, last))


def on_unix_day(df: DataFrame, ts_col: str, seconds: int | str) -> DataFrame:
    """Keep rows on the UTC day of a Unix instant (F9), as a pushable range."""
    return df.filter(day_range(ts_col, unix_day(seconds), _dtype(df, ts_col)))


def overnight_only(
    df: DataFrame, start_col: str, end_col: str, out: str = "date_diff"
) -> DataFrame:
    """Rows ending on a later calendar day than they start.

    Backwards rows (end before start) have a negative difference and go.
    """
    return df.withColumn(out, F.datediff(F.col(end_col), F.col(start_col))).filter(F.col(out) > 0)


# Spark's day-of-week numbers for the weekend, Sunday = 1, Saturday = 7.
WEEKEND_DAYS = {1: "Sunday", 7: "Saturday"}


def weekend_only(df: DataFrame, ts_col: str, out: str = "day_of_week") -> DataFrame:
    """Rows starting on Saturday or Sunday, with the day's name in ``out``."""
    day = F.dayofweek(F.col(ts_col))
    return df.filter(day.isin(list(WEEKEND_DAYS))).withColumn(
        out, F.when(day == 1, F.lit(WEEKEND_DAYS[1])).otherwise(F.lit(WEEKEND_DAYS[7]))
    )
