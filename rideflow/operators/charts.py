"""The small tables behind charts (2.16).

Drawing happens on one machine; what runs on the cluster is the aggregation
that produces the few rows a chart shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.operators.aggregates import value_shares
from rideflow.operators.sampling import hash_sample


def bar_chart_data(
    df: DataFrame,
    category: str,
    cutoff: float = 50.0,
    highlight: str | None = None,
) -> DataFrame:
    """One row per category, largest bar first: share in percent, label and flags (V1).

    Rows come sorted as the bars are drawn (count descending, then category).
    ``label`` is the whole-percent text printed on the bar, ``above_cutoff``
    tells whether the bar passes the cutoff line and ``highlight`` marks the
    chosen bar.  The bar order is the sort itself, so no window over all
    categories is needed.
    """
    shares = value_shares(df, category, fmt="%.0f%%", text_col="label", share_col="percent")
    return shares.select(
        F.col(category).alias("category"),
        F.col("count"),
        F.col("percent"),
        F.col("label"),
        (F.col("percent") > F.lit(cutoff)).alias("above_cutoff"),
        (F.col(category) == F.lit(highlight)).alias("highlight")
        if highlight is not None
        else F.lit(False).alias("highlight"),
    )


def scatter_series(
    df: DataFrame,
    x: str,
    y: str,
    in_class: Column,
    labels: tuple[str, str] = ("selected", "other"),
    sample_key: str | None = None,
    sample_fraction: float = 1.0,
) -> DataFrame:
    """Points of a scatter plot with their series label (V2).

    ``in_class`` splits the points into two series (a null predicate counts
    as "other").  With ``sample_key`` and a fraction below 1 a reproducible
    hash sample keeps the point count drawable.
    """
    if sample_key is not None and sample_fraction < 1.0:
        df = hash_sample(df, sample_key, sample_fraction)
    return df.select(
        F.col(x),
        F.col(y),
        F.when(F.coalesce(in_class, F.lit(False)), F.lit(labels[0])).otherwise(F.lit(labels[1])).alias("series"),
    )
