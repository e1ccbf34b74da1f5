"""Tables as multisets of rows: differences, intersections and changes by key, and lattices of groups.

Everything rests on counts per distinct row, which tasks sum up before anything is shuffled: a row
repeated in a third of the table is one row per task there.  Nulls equal nulls, as in SQL's set
operations.  Columns are matched by name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies that one array holds while rows are replayed.
_COPIES = 100_000


def _same_columns(left: DataFrame, right: DataFrame) -> list[str]:
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {', '.join(sorted(set(left.columns) ^ set(right.columns)))}")
    return left.columns


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row of either table, as struct ``row``, with its copies ``n_left`` and ``n_right``."""
    columns = _same_columns(left, right)
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    sides = [df.select(row, F.lit(a).alias("l"), F.lit(b).alias("r")) for df, a, b in ((left, 1, 0), (right, 0, 1))]
    both = sides[0].unionByName(sides[1])
    return both.groupBy("row").agg(F.sum("l").cast("long").alias("n_left"), F.sum("r").cast("long").alias("n_right"))


def _replayed(counts: DataFrame, n: Column, columns: Sequence[str]) -> DataFrame:
    """Each row as often as ``n`` says, in arrays of bounded length."""
    some = counts.select("row", n.cast("long").alias("n")).filter("n > 0")
    parts = some.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))))
    size = F.least(F.col("n") - F.col("part") * _COPIES, F.lit(_COPIES)).cast("int")
    copies = parts.select("row", F.explode(F.array_repeat(F.lit(1), size)).alias("copy"))
    return copies.select(*[F.col("row")[c].alias(c) for c in columns])


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without as many copies as ``right`` has of them."""
    return _replayed(row_counts(left, right), F.col("n_left") - F.col("n_right"), left.columns)


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables, as many copies as the table with fewer has."""
    return _replayed(row_counts(left, right), F.least("n_left", "n_right"), left.columns)


def table_changes(before: DataFrame, after: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row per key whose rows differ: the keys, ``change`` (added, removed or changed), and how many
    rows went (``n_removed``) and came (``n_added``).  Keys may be null or repeated."""
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    counts = row_counts(before, after).filter("n_left <> n_right")
    delta = F.col("n_left") - F.col("n_right")
    grouped = counts.groupBy(*[F.col("row")[k].alias(k) for k in key_cols]).agg(
        F.sum(F.greatest(delta, F.lit(0))).alias("n_removed"), F.sum(F.greatest(-delta, F.lit(0))).alias("n_added")
    )
    change = F.when(F.col("n_removed") == 0, "added").when(F.col("n_added") == 0, "removed").otherwise("changed")
    return grouped.select(*key_cols, change.alias("change"), "n_removed", "n_added")


def grouping_lattice(
    df: DataFrame,
    dims: Sequence[str],
    sums: Mapping[str, Column | str],
    distinct: str | None = None,
    *,
    sets: Sequence[Sequence[str]] | None = None,
    count: str = "n",
    distinct_out: str = "n_distinct",
) -> DataFrame:
    """Counts and sums for every set of ``dims`` (or for ``sets``), with the distinct values of a column.

    Returns the dimensions (null where a set leaves one out), ``grouping`` (the bits of the dimensions
    left out, the last dimension being the lowest, as SQL's GROUPING), ``count``, the sums, and
    ``distinct_out``.  Input rows are shuffled once, already summed per dimension values and distinct
    value; the sets are made from those sums, not from the rows.
    """
    sets = [list(c) for r in range(len(dims), -1, -1) for c in combinations(dims, r)] if sets is None else [list(s) for s in sets]
    values = {o: F.col(v) if isinstance(v, str) else v for o, v in sums.items()}
    places = [F.col(f"`{d}`").alias(f"_d{i}") for i, d in enumerate(dims)]
    own = [F.col(f"`{distinct}`").alias("_v")] if distinct else []
    finest = df.groupBy(*places, *own).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_s{i}") for i, v in enumerate(values.values())])
    kinds = {f.name: f.dataType for f in finest.schema}

    def masked(chosen: Sequence[str]) -> Column:
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in chosen)
        kept = [(F.col(f"_d{i}") if d in chosen else F.lit(None).cast(kinds[f"_d{i}"])).alias(f"_d{i}") for i, d in enumerate(dims)]
        return F.struct(F.lit(bits).alias("grouping"), *kept)

    expanded = finest.withColumn("_set", F.explode(F.array(*[masked(s) for s in sets])))
    names = ["grouping", *[f"_d{i}" for i in range(len(dims))]]
    by_set = expanded.select("_set.*", *(["_v"] if distinct else []), "_n", *[f"_s{i}" for i in range(len(values))])

    def summed(rows: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("_n").alias("_n"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(values))], *more)

    if distinct:
        by_set = summed(summed(by_set, [*names, "_v"]), names, F.count("_v").alias("_distinct"))
    else:
        by_set = summed(by_set, names)
    types = {f.name: f.dataType for f in df.agg(*[F.sum(v).alias(o) for o, v in values.items()]).schema} if values else {}
    return by_set.select(
        *[F.col(f"_d{i}").alias(d) for i, d in enumerate(dims)],
        "grouping",
        F.col("_n").alias(count),
        *[F.col(f"_s{i}").cast(types[o]).alias(o) for i, o in enumerate(values)],
        *([F.col("_distinct").alias(distinct_out)] if distinct else []),
    )
