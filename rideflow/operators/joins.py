"""Joins (2.5).

No join here carries a broadcast hint.  Spark broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (at planning
time from statistics, and again at run time under AQE from the real shuffle
size), and otherwise falls back to a sort-merge join; AQE's skew-join rule
splits hot keys of the large side.  That is the size-checked broadcast with
a fallback, without trusting a table to stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dim(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    dim_filter: Column | None = None,
    how: str = "inner",
) -> DataFrame:
    """Equi-join on ``df[key] == dim[dim_key]`` with an optional dimension filter.

    Both key columns are kept.  The filter is applied to the dimension before
    the join, so it is pushed into the dimension scan.
    """
    if dim_filter is not None:
        dim = dim.filter(dim_filter)
    return df.join(dim, df[key] == dim[dim_key], how)


def label_dim(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, prefix: str, how: str = "inner"
) -> DataFrame:
    """Join on a shared key name, the dimension's other columns prefixed.

    ``pickup_`` + ``zone_name`` → ``pickup_zone_name``, as when one dimension is
    joined twice under two roles.
    """
    renamed = dim.select(
        F.col(dim_key).alias(key),
        *[F.col(c).alias(f"{prefix}{c}") for c in dim.columns if c != dim_key],
    )
    return df.join(renamed, on=key, how=how)


def enrich_left(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left outer join: unmatched rows keep nulls in the dimension's columns."""
    return df.join(dim, on=on, how="left")


def exclude_by_dim(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    predicate: Column,
    mode: str = "anti",
) -> DataFrame:
    """Drop rows whose key points at a dimension row matching ``predicate``.

    ``mode="anti"`` (canonical): left anti join against the matching dimension
    keys.  Rows with a null key or a key absent from the dimension survive.

    ``mode="matched_only"``: keep a row only if the dimension has a row for its
    key that does not match the predicate (an inner join followed by a negated
    filter).  Rows with null or unknown keys go.  Implemented as a left semi
    join, so a key repeated in the dimension does not multiply rows.
    """
    if mode == "anti":
        hits = dim.filter(predicate).select(F.col(dim_key).alias("_dim_key"))
        return df.join(hits, F.col(key) == F.col("_dim_key"), "left_anti")
    if mode == "matched_only":
        others = dim.filter(F.coalesce(~predicate, F.lit(False))).select(
            F.col(dim_key).alias("_dim_key")
        )
        return df.join(others, F.col(key) == F.col("_dim_key"), "left_semi")
    raise ValueError(f"unknown mode {mode!r}")


def _key_counts(df: DataFrame, key: str, out: str) -> DataFrame:
    # Partial (map-side) aggregation first: a key holding a third of all rows
    # leaves each map task as one row.
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("chain_key")).agg(
        F.count(F.lit(1)).alias(out)
    )


def chain_pairs(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Per join key, how many (left, right) pairs a chaining join would form.

    ``left`` rows end where ``right`` rows start (``left[left_key] ==
    right[right_key]``).  The pairs are not materialised: a key with ``a``
    rows on one side and ``b`` on the other gives one row ``(key, a, b, a*b)``.
    The product is a ``decimal(38,0)``: two hot keys of billions of rows pass 64 bits.
    """
    a = _key_counts(left, left_key, "n_left")
    b = _key_counts(right, right_key, "n_right")
    return a.join(b, "chain_key").withColumn("n_pairs", _pairs("n_left", "n_right"))


def _pairs(left: str, right: str) -> Column:
    wide = "decimal(19,0)"  # holds any bigint; the product of two has 38 digits
    return (F.col(left).cast(wide) * F.col(right).cast(wide)).cast("decimal(38,0)")


def chain_pair_count(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Number of rows the chaining self-join would produce, as one row."""
    return chain_pairs(left, left_key, right, right_key).agg(
        F.coalesce(F.sum("n_pairs"), F.lit(0)).cast("decimal(38,0)").alias("n_pairs")
    )


def batch_pair_counts(
    batches: DataFrame, batch: str, left_key: str, right: DataFrame, right_key: str, n_batches: int
) -> DataFrame:
    """Per batch, how many pairs its rows form with the whole of ``right`` (J7 over M3).

    ``batches`` has a batch number from 0 in ``batch``; a batch without a pair,
    or without rows, has the count 0.  Both sides are counted per key before
    they meet, so a hot key is one row per batch.
    """
    a = batches.filter(F.col(left_key).isNotNull()).groupBy(F.col(batch).alias("_batch"), F.col(left_key).alias("chain_key")).agg(
        F.count(F.lit(1)).alias("n_left")
    )
    pairs = a.join(_key_counts(right, right_key, "n_right"), "chain_key").withColumn("n_pairs", _pairs("n_left", "n_right"))
    per_batch = pairs.groupBy("_batch").agg(F.sum("n_pairs").alias("n_pairs"))
    numbers = batches.sparkSession.range(n_batches).select(F.col("id").cast("int").alias(batch))
    return numbers.join(per_batch, F.col(batch) == F.col("_batch"), "left").select(
        batch, F.coalesce("n_pairs", F.lit(0)).cast("decimal(38,0)").alias("n_pairs")
    )


def top_by(df: DataFrame, order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """Top ``n`` rows by ``order`` (J8, L4); planned as a per-partition top-k + merge."""
    return df.orderBy(*order).limit(n)
