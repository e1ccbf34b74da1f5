"""User-defined functions.

The native forms (``ceil_int``, ``cos_float``) are what a job should use: they
stay in whole-stage code generation.  The UDF forms exist because the
reference teaches the UDF surface; they are Arrow-batched pandas UDFs, never
row-at-a-time, and return null for null input instead of raising.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.functions.columns import ColumnLike, col_of


def ceil_int(c: ColumnLike) -> Column:
    """Round up to an integer, native."""
    return F.ceil(col_of(c)).cast("int")


def cos_float(c: ColumnLike) -> Column:
    """Cosine as a 32-bit float, native."""
    return F.cos(col_of(c)).cast("float")


@F.pandas_udf(T.IntegerType())
def ceil_udf(values: pd.Series) -> pd.Series:
    """Round up to an integer, one Arrow batch at a time."""
    return np.ceil(values).astype("Int32")


@F.pandas_udf(T.FloatType())
def cos_udf(values: pd.Series) -> pd.Series:
    """Cosine as a 32-bit float, one Arrow batch at a time."""
    return np.cos(values.astype("float64")).astype("float32")
