"""Approximate distinct counts and quantiles as stored states that can be merged (2.6).

A state table has one row per group with the count of its rows, an HLL state of one column's distinct
values and a KLL state of another column's values.  States of a fine level (days) merge into any coarser
one (months, all) without reading the rows again, and tables of different days may be united and merged.
A state's size depends on its precision, not on the rows behind it, and states are built in the tasks
that read the rows, so a hot group costs one state per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that distinct states take as they are; others are taken by their text.
_PLAIN = ("int", "bigint", "string", "binary")
STATE_COLUMNS = ("n", "distinct_state", "quantile_state")


def _groups(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    clash = set(keys) & set(STATE_COLUMNS)
    if clash:
        raise ValueError(f"keys may not be named {sorted(clash)}")
    return [F.col(f"`{k}`") for k in keys]


def sketch_states(
    df: DataFrame, keys: Sequence[str], distinct: str, value: str, *, log2_registers: int = 14, k: int = 400
) -> DataFrame:
    """One row per group: keys, n (rows), distinct_state of ``distinct``, quantile_state of ``value``.

    The distinct count is off by about 1.04 / sqrt(2 ** log2_registers) (0.8 %), a quantile's rank by less
    than 1 % at k = 400.  Nulls enter neither state, NaN no quantile; null keys are a group; no rows give
    no states, and one state of none if ``keys`` is empty.
    """
    plain = dict(df.dtypes)[distinct] in _PLAIN
    item = F.col(f"`{distinct}`") if plain else F.col(f"`{distinct}`").cast("string")
    number = F.col(f"`{value}`").cast("double")
    return df.groupBy(*_groups(df, keys)).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(item, log2_registers).alias("distinct_state"),
        F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k).alias("quantile_state"),
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of coarser groups: rows of ``states`` that agree in ``keys`` become one state."""
    return states.groupBy(*_groups(states, keys)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"),
    )


def read_states(states: DataFrame, quantiles: Mapping[str, float], *, distinct_out: str = "n_distinct") -> DataFrame:
    """What the states say: their keys, n, the distinct count in ``distinct_out`` and a column for each of
    ``quantiles`` (output name to a share of 0 to 1); null where the state has no values."""
    some = F.kll_sketch_get_n_double("quantile_state") > 0
    return states.select(
        *[F.col(f"`{c}`") for c in states.columns if c not in STATE_COLUMNS],
        "n",
        F.hll_sketch_estimate("distinct_state").alias(distinct_out),
        *[F.when(some, F.kll_sketch_get_quantile_double("quantile_state", F.lit(float(q)))).alias(name) for name, q in quantiles.items()],
    )
