"""Aggregations and deduplication (2.6).

Every aggregate here is a hash aggregate with a partial (map-side) step, so a
key holding a third of all rows leaves each map task as one row before the
shuffle.  Totals are scalar subqueries over the already aggregated result,
never a window over ``lit(1)`` that would pull every row into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def top_values(df: DataFrame, col: str, n: int = 3, count_col: str = "count") -> DataFrame:
    """Most frequent values of ``col``, ties broken by the value (G1)."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias(count_col))
        .orderBy(F.desc(count_col), F.asc_nulls_first(col))
        .limit(n)
    )


def value_shares(
    df: DataFrame,
    col: str,
    fmt: str = "%2.2f%%",
    n: int | None = None,
    count_col: str = "count",
    share_col: str = "share",
    text_col: str = "percentage",
) -> DataFrame:
    """Counts per value, their share of all rows in percent and as text.

    The total is the sum of the group counts, taken as a scalar subquery over
    the aggregated result: one extra tiny job, and the grouped rows stay
    spread over all partitions.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    total = counts.agg(F.sum(count_col)).scalar()
    shares = (
        counts.withColumn(share_col, F.try_divide(F.col(count_col).cast("double") * 100.0, total.cast("double")))
        .withColumn(text_col, F.when(F.col(share_col).isNotNull(), F.format_string(fmt, F.col(share_col))))
        .orderBy(F.desc(count_col), F.asc_nulls_first(col))
    )
    return shares.limit(n) if n is not None else shares


def max_where(df: DataFrame, value: str, predicate: Column | None = None, out: str | None = None) -> DataFrame:
    """Global maximum of ``value`` over the rows matching ``predicate`` (G3), one row."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.agg(F.max(value).alias(out or f"max_{value}"))


def group_stats(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """``count(*)`` and ``max(value)`` per group."""
    return df.groupBy(*_names(keys)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(value).alias(f"max_{value}")
    )


def values_per_group(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """The values of ``value`` per group, as rows (keys, value, n).

    The multiset of a group whatever its size: nothing holds a group together.
    """
    return df.groupBy(*_names(keys), value).agg(F.count(F.lit(1)).alias("n"))


def collect_values(
    df: DataFrame, keys: str | Sequence[str], value: str, out: str = "values"
) -> DataFrame:
    """The values of ``value`` per group, as one sorted array (G5), for a column of few values.

    Each group gets ``array<struct<value, n>>`` sorted by value: every distinct
    value with its number of occurrences.  The array grows with the number of
    distinct values; where that is not small, use ``values_per_group``.
    """
    key_names = _names(keys)
    return values_per_group(df, key_names, value).groupBy(*key_names).agg(
        F.array_sort(F.collect_list(F.struct(F.col(value).alias("value"), F.col("n")))).alias(out),
        F.sum("n").alias(f"n_{out}"),
    )


def dedup_all(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.dropDuplicates()


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType | T.VariantType):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def total_order(df: DataFrame, order: Sequence[Column | str], exclude: Sequence[str] = ()) -> list[Column]:
    """``order`` followed by every other orderable column: a deterministic order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    named = {c for c in order if isinstance(c, str)} | set(exclude)
    rest = [F.col(f.name) for f in df.schema.fields if f.name not in named and _orderable(f.dataType)]
    return cols + rest


def dedup_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, remaining ties broken by all columns.

    ``row_number() = 1`` lets Spark insert a partial group limit before the
    shuffle, so only one row per key and map task crosses the network.
    """
    key_names = _names(keys)
    window = Window.partitionBy(*key_names).orderBy(*total_order(df, order, exclude=key_names))
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= 1).drop("_rn")


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], count_col: str = "count") -> DataFrame:
    """Keys that occur more than once, with their counts (G9); empty means unique."""
    return (
        df.groupBy(*_names(keys))
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(out))


def dedup_report(df: DataFrame, keys: str | Sequence[str] | None = None) -> DataFrame:
    """Rows before and after deduplication on ``keys`` (all columns by default), one job."""
    key_names = _names(keys) if keys is not None else df.columns
    return (
        df.groupBy(*key_names)
        .agg(F.count(F.lit(1)).alias("_c"))
        .agg(
            F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n_before"),
            F.count(F.lit(1)).alias("n_after"),
        )
    )
