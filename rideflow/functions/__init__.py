"""Column-level functions."""

from rideflow.functions.columns import (
    DATE_PARTS,
    LONG_DATE,
    clamp,
    col_of,
    date_parts,
    day_range,
    doubled_unix_date,
    flag_is,
    format_date,
    hour_between,
    month_equals,
    month_range,
    name_contains,
    percent_text,
    scale_if,
    scaled_by_name_length,
    typed_literal,
    unix_day,
)
from rideflow.functions.udfs import ceil_int, ceil_udf, cos_float, cos_udf

__all__ = [
    "DATE_PARTS",
    "LONG_DATE",
    "ceil_int",
    "ceil_udf",
    "clamp",
    "col_of",
    "cos_float",
    "cos_udf",
    "date_parts",
    "day_range",
    "doubled_unix_date",
    "flag_is",
    "format_date",
    "hour_between",
    "month_equals",
    "month_range",
    "name_contains",
    "percent_text",
    "scale_if",
    "scaled_by_name_length",
    "typed_literal",
    "unix_day",
]
