"""Projections (2.3) and result display helpers (2.2)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from rideflow.functions.columns import (
    DATE_PARTS,
    LONG_DATE,
    date_parts,
    flag_is,
    format_date,
    scaled_by_name_length,
)


def add_date_parts(
    df: DataFrame, ts_col: str, parts: Mapping[str, Callable[[Column], Column]] = DATE_PARTS
) -> DataFrame:
    """Add month, day_of_week and day_of_month of ``ts_col`` in one projection."""
    return df.withColumns(date_parts(ts_col, parts))


def add_features(
    df: DataFrame,
    ts_col: str,
    flag_col: str,
    flag_value: str,
    flag_out: str | None = None,
    encoding: tuple[int, int] = (1, 0),
) -> DataFrame:
    """The job's feature step (R2): date parts plus a flag encoding.

    By default a new column ``{flag}_is_{value}`` is 1 on a match and 0
    otherwise (null included).  The prototype's variant re-encodes the flag in
    place with the opposite values: ``flag_out=flag_col, encoding=(0, 1)``.
    """
    out = flag_out or f"{flag_col}_is_{flag_value}"
    return add_date_parts(df, ts_col).withColumn(out, flag_is(flag_col, flag_value, *encoding))


def scale_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Insert ``c * len(c)`` (aliased ``"{c} * {len}"``) before the scaled columns.

    Columns are chosen by name, not by position.
    """
    chosen = list(columns)
    if not chosen:
        return df
    names = df.columns
    first = min(names.index(c) for c in chosen)
    return df.select(*names[:first], *scaled_by_name_length(chosen), *names[first:])


def _date_alias(name: str) -> str:
    # pickup_datetime -> pickup_date; other names get a suffix.
    return name[:-4] if name.endswith("datetime") else f"{name}_text"


def format_dates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    pattern: str = LONG_DATE,
    alias: Callable[[str], str] = _date_alias,
) -> DataFrame:
    """Append a formatted copy of each date column.

    Without ``columns`` every column whose name contains ``datetime`` is used.
    """
    chosen = list(columns) if columns is not None else [c for c in df.columns if "datetime" in c]
    return df.select("*", *[format_date(c, pattern).alias(alias(c)) for c in chosen])


def head_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows in a given order (A1, A2): a deterministic ``show``."""
    return df.orderBy(*order).limit(n)
