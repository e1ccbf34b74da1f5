"""Exact quantiles per group without sorting the rows of large groups.

Groups of at most ``max_sorted`` values are sorted, each in one task, which is one shuffle of them however
many there are.  In larger ones each pass is one aggregate: the values that may still be the quantile of their group are counted in
bins between the least and the greatest of them, and the bin that holds the sought rank becomes the
next pass' range, with its true least and greatest value.  A group is done when these are equal.  Rows
are only read and counted, with partial sums in the tasks that read them, so a hot group costs no more
than others; a group's state is one row per quantile.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.sources.sinks import materialize

_BINS = 1024


def _place(value: Column, pass_number: int) -> Column:
    """A number that never falls as ``value`` rises: itself, or in every third pass its logarithm, which
    tells apart values of very different sizes."""
    x = value.cast("double")
    return F.signum(x) * F.log1p(F.abs(x)) if pass_number % 3 == 2 else x


def exact_quantiles(
    df: DataFrame, keys: str | Sequence[str], value: str, quantiles: Mapping[str, str | float], *, max_sorted: int = 100_000
) -> DataFrame:
    """One row per group of ``keys`` with, for each of ``quantiles`` (output name to a share of 0 to 1),
    the smallest value whose rank is at least that share of the group's values.

    The result has the value's type.  Nulls and NaN do not count; a group without values gets null.
    ``value`` is a number, or a date or timestamp.  ``max_sorted``: groups of more values are not sorted.
    """
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    names = [f"_key{i}" for i in range(len(key_cols))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, names)], F.col(f"`{value}`").alias("v"))
    kind = rows.schema["v"].dataType.simpleString()
    number = F.unix_micros(F.col("v").cast("timestamp")) if kind in ("date", "timestamp", "timestamp_ntz") else F.col("v")
    valid = F.col("v").isNotNull() & (~F.isnan("v") if kind in ("double", "float") else F.lit(True))
    rows = rows.withColumn("x", F.when(valid, number))
    shares = [Decimal(str(q)) for q in quantiles.values()]
    if any(not 0 <= q <= 1 for q in shares):
        raise ValueError("quantiles are shares from 0 to 1")

    groups = materialize(rows.groupBy(*names).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")), label="quantile-groups")
    ranks = [F.greatest(F.ceil(F.col("n").cast("decimal(18,0)") * F.lit(q).cast("decimal(20,18)")).cast("long"), F.lit(1).cast("long")) for q in shares]
    back = (lambda x: F.timestamp_micros(x).cast(kind)) if kind in ("date", "timestamp", "timestamp_ntz") else (lambda x: F.col(x).cast(kind))
    of_names = [f"_of{n}" for n in names]
    same_group = F.lit(True)
    for n, of in zip(names, of_names):
        same_group = same_group & F.col(n).eqNullSafe(F.col(of))

    # Groups that are sorted: the values whose place is a rank.
    sorted_ = groups.filter(F.col("n").between(1, max_sorted))
    ranked = sorted_.select(*[F.col(n).alias(of) for n, of in zip(names, of_names)], *[r.alias(f"_rank{i}") for i, r in enumerate(ranks)])
    place = F.row_number().over(Window.partitionBy(*of_names).orderBy("x"))
    placed = rows.filter(F.col("x").isNotNull()).select(*names, "x").join(ranked, same_group).drop(*names).withColumn("place", place)
    hits = placed.filter(F.expr(" OR ".join(["false", *[f"place = _rank{i}" for i in range(len(shares))]])))
    outs = [F.max(F.when(F.col("place") == F.col(f"_rank{i}"), back("x"))).alias(f"_out{i}") for i in range(len(shares))]
    found = materialize(hits.groupBy(*of_names).agg(*outs), label="quantile-sorted")

    # The others, pass by pass.
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), r.alias("rank")) for i, r in enumerate(ranks)])).alias("w")
    state = groups.filter(F.col("n") > max_sorted).select(*names, "lo", "hi", which).select(*names, "w.q", "w.rank", "lo", "hi")
    state = materialize(state, label="quantile-state")
    done, number_of_pass = state.filter("lo = hi"), 0
    while True:
        open_ = state.filter("lo < hi")
        if open_.isEmpty():
            break
        sought = open_.withColumnsRenamed(dict(zip(names, of_names)))
        cond = same_group & F.col("x").between(F.col("lo"), F.col("hi"))
        lo, hi, x = (_place(F.col(c), number_of_pass) for c in ("lo", "hi", "x"))
        at = F.least(F.floor((x - lo) / (hi - lo) * _BINS), F.lit(_BINS - 1))
        # Values that are one and the same as a double: the least apart from the others.
        bin_ = F.when(hi > lo, at).otherwise(F.when(F.col("x") > F.col("lo"), 1).otherwise(0)).cast("int")
        counts = (
            rows.filter(F.col("x").isNotNull())
            .join(sought, cond)
            .groupBy(*names, "q", "rank", bin_.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        )
        # Counts up to each bin, at most _BINS of them; the first that reaches the rank.
        up_to = F.sum("n").over(Window.partitionBy(*names, "q").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        before = counts.withColumn("before", up_to - F.col("n"))
        chosen = before.filter((F.col("before") < F.col("rank")) & (F.col("before") + F.col("n") >= F.col("rank")))
        state = chosen.select(*names, "q", (F.col("rank") - F.col("before")).alias("rank"), "lo", "hi")
        state = materialize(state, label="quantile-state")
        done = done.unionByName(state.filter("lo = hi"))
        number_of_pass += 1

    outs = [F.max(F.when(F.col("q") == i, back("lo"))).alias(f"_out{i}") for i in range(len(shares))]
    found = found.unionByName(done.groupBy(*[F.col(n).alias(of) for n, of in zip(names, of_names)]).agg(*outs))
    joined = groups.join(found, same_group, "left")
    return joined.select(*[F.col(n).alias(k) for n, k in zip(names, key_cols)], *[F.col(f"_out{i}").alias(o) for i, o in enumerate(quantiles)])
