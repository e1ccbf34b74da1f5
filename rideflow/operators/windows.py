"""Window operators (2.7).

Top-n per group is written as ``row_number() <= n`` directly after the
window, which lets Spark put a partial group limit before the shuffle: at
most ``n`` rows per group and map task are exchanged, however hot the group.

Running sums over few, large groups cannot be cut that way: a plain window
puts each group in one task.  ``running_totals(..., buckets=...)`` splits every
group into ordered ranges, writes each row down with the number of its range,
sums each range on its own, and adds the totals of the earlier ranges of the
same group, a table of at most ``ranges + keys`` rows.  Both sides read the
number from the files, so they cannot disagree about a row's range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.operators.aggregates import total_order
from rideflow.sources.sinks import materialize


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def latest_n(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    n: int = 3,
    out: str | None = "row_number",
) -> DataFrame:
    """The first ``n`` rows per key by ``order`` (W1); ``order`` must be total for ties.

    With ``order=[F.desc(ts), ...]`` this is "latest n".  The rank is kept in
    ``out`` (as bigint) unless ``out`` is None.
    """
    rank = out or "_rn"
    window = Window.partitionBy(*_names(keys)).orderBy(*_cols(order))
    ranked = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("bigint")) if out else ranked.drop(rank)


def first_n_daily(
    df: DataFrame,
    key: str | Sequence[str],
    ts_col: str,
    n: int = 3,
    tie_breakers: Sequence[Column | str] = (),
) -> DataFrame:
    """The first ``n`` rows per key and calendar day of ``ts_col``.

    The day is ``to_date(ts)``, which groups exactly like a ``yyyyMMdd`` or
    ``ddMMyyyy`` string; the helper column is dropped.
    """
    keyed = df.withColumn("_day", F.to_date(F.col(ts_col)))
    order = [F.asc(ts_col), *_cols(tie_breakers)]
    return latest_n(keyed, [*_names(key), "_day"], order, n, out=None).drop("_day")


def ordered_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    buckets: int | None = None,
    out: str = "_bucket",
) -> DataFrame:
    """Rows with the number of their range of (keys, order), ranges numbered in that order.

    The range bounds come from a sample of the data, so a key holding a third
    of all rows spans about a third of the ranges instead of one task, and so
    does a value of the first order column: every order column takes part.
    Without ``buckets`` the exchange has ``spark.sql.shuffle.partitions``
    partitions and AQE joins small ones, so that ranges follow the data's size.

    The rows are written below ``spark.checkpoint.dir``: a range exchange that
    is planned twice may sample twice and cut elsewhere.
    """
    cols = [*[F.col(k) for k in keys], *_cols(order)]
    ranged = df.repartitionByRange(*cols) if buckets is None else df.repartitionByRange(buckets, *cols)
    return materialize(ranged.withColumn(out, F.spark_partition_id()), label="ranges")


def _wide(value: Column, dtype: T.DataType) -> Column:
    """``value`` in a type in which partial sums cannot overflow before the sum itself does.

    The total of a range of bigints can leave the 64-bit range although no
    running sum does (2**62 up and down again).
    """
    return value.cast("decimal(38,0)") if isinstance(dtype, T.LongType) else value


def running_totals(
    df: DataFrame,
    sums: Mapping[str, Column | str],
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    buckets: int | str | None = None,
    bucket_by: Column | None = None,
) -> DataFrame:
    """Running sums (rows from the first to the current one) per key.

    ``sums`` maps an output name to the value summed; results have the type
    Spark gives ``sum``.  ``order`` should be total (add tie-breakers).  Three
    plans:

    * neither option: one window per key (one task per key);
    * ``buckets=k`` or ``"auto"``: rows are split into ranges of (key, order)
      by ``ordered_ranges`` (``"auto"``: as many as the data's size asks for),
      so any key, however hot, spans many tasks;
    * ``bucket_by=col``: a coarse column that never decreases along ``order``
      within a key (e.g. the hour of the ordering timestamp) defines the
      ranges.  One shuffle, no sampling and nothing written; a single
      (key, bucket) stays one task.
    """
    key_names = _names(keys)
    order_cols = _cols(order)
    values = {out: F.col(v) if isinstance(v, str) else v for out, v in sums.items()}
    if buckets is None and bucket_by is None:
        frame = (
            Window.partitionBy(*key_names)
            .orderBy(*order_cols)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.withColumns({out: F.sum(v).over(frame) for out, v in values.items()})

    # Analysis only, nothing runs: the values' types and those Spark gives their sums.
    types = {f.name: f.dataType for f in df.select(*[v.alias(o) for o, v in values.items()]).schema}
    sum_types = {f.name: f.dataType for f in df.agg(*[F.sum(v).alias(o) for o, v in values.items()]).schema}
    # 1. Ordered ranges: rows of one key are contiguous, ranges numbered in order.
    if bucket_by is not None:
        ranged = df.withColumn("_bucket", bucket_by)
    else:
        ranged = ordered_ranges(df, key_names, order_cols, None if buckets == "auto" else buckets)
    # 2. Running sums inside each (key, range).
    local_frame = (
        Window.partitionBy(*key_names, "_bucket")
        .orderBy(*order_cols)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    wide = {out: _wide(v, types[out]) for out, v in values.items()}
    local = ranged.withColumns({f"_local_{out}": F.sum(v).over(local_frame) for out, v in wide.items()})
    # 3. Totals of the earlier ranges of the same key: one row per (key, range).
    totals = ranged.groupBy(*key_names, "_bucket").agg(*[F.sum(v).alias(f"_total_{out}") for out, v in wide.items()])
    before = Window.partitionBy(*key_names).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(key_names)],
        F.col("_bucket").alias("_obucket"),
        *[F.sum(f"_total_{out}").over(before).alias(f"_offset_{out}") for out in sums],
    )
    cond = F.col("_bucket").eqNullSafe(F.col("_obucket"))
    for i, k in enumerate(key_names):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    # A left join: a row is never lost, and every (key, range) has its row in the offsets.
    joined = local.join(offsets, cond, "left")
    results = {}
    for out in sums:
        loc, off = F.col(f"_local_{out}"), F.col(f"_offset_{out}")
        total = F.when(loc.isNull(), off).when(off.isNull(), loc).otherwise(loc + off)
        results[out] = total.cast(sum_types[out])
    helper = ["_bucket", "_obucket", *[f"_key_{i}" for i in range(len(key_names))]]
    helper += [f"_local_{o}" for o in sums] + [f"_offset_{o}" for o in sums]
    return joined.withColumns(results).drop(*helper)


def running_sum(
    df: DataFrame,
    value: Column | str,
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    out: str = "running_sum",
    buckets: int | str | None = None,
    bucket_by: Column | None = None,
) -> DataFrame:
    """One running sum (W3); see ``running_totals``."""
    return running_totals(df, {out: value}, keys, order, buckets, bucket_by)


def rows_to_reach(
    df: DataFrame,
    value: Column | str,
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    target: float,
    mode: str = "reference",
    out: str = "rows_count",
    buckets: int | str | None = None,
    bucket_by: Column | None = None,
) -> DataFrame:
    """Rows needed per key for the running sum of ``value`` to reach ``target``.

    ``mode="reference"``: keep rows whose running sum is at most the target;
    a key gets their count if the largest kept sum equals or passes the
    target, else null.  So the sum must hit the target exactly; keys with no
    kept row do not appear.

    ``mode="first_crossing"``: the position of the first row whose running sum
    is at least the target, null if it never gets there; every key appears.

    Use a decimal ``value`` when exact equality matters.
    """
    key_names = _names(keys)
    if mode == "reference":
        running = running_totals(df, {"_run": value}, key_names, order, buckets, bucket_by)
        kept = running.filter(F.col("_run") <= F.lit(target))
        return kept.groupBy(*key_names).agg(
            F.when(F.max("_run") >= F.lit(target), F.count(F.lit(1)))
            .otherwise(F.lit(None))
            .cast("bigint")
            .alias(out)
        )
    if mode == "first_crossing":
        running = running_totals(
            df, {"_run": value, "_pos": F.lit(1).cast("bigint")}, key_names, order, buckets, bucket_by
        )
        return running.groupBy(*key_names).agg(
            F.min(F.when(F.col("_run") >= F.lit(target), F.col("_pos"))).cast("bigint").alias(out)
        )
    raise ValueError(f"unknown mode {mode!r}")


def latest_n_array(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    payload: Column | str,
    n: int = 5,
    out: str = "payloads",
    break_ties: bool = False,
) -> DataFrame:
    """The payloads of the first ``n`` rows per key by ``order``, as one ordered array.

    The array holds at most ``n`` elements and its order is the window order,
    so element ``i`` means "the (i+1)-th latest".  ``order`` should be total;
    ``break_ties=True`` appends every other column to make it so (a longer sort).
    ``payload`` may be any expression over ``df``'s columns (a struct, say); it
    is evaluated only for the kept rows, after the top-n filter.
    """
    key_names = _names(keys)
    payload_col = F.col(payload) if isinstance(payload, str) else payload
    ordering = total_order(df, order, exclude=key_names) if break_ties else _cols(order)
    top = latest_n(df, key_names, ordering, n, out="_rn").withColumn("_payload", payload_col)
    return top.groupBy(*key_names).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col("_payload")))),
            lambda x: x["_payload"],
        ).alias(out)
    )
