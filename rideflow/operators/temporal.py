"""Operators along a time axis: as-of and interval joins, sliding time frames, sessions.

A plain window or sort-merge by key puts a key in one task.  Here rows are cut into ordered ranges of
(key, time) by ``windows.ordered_ranges``, so that a key of a third of all rows spans many tasks, and
what crosses a cut is carried by a small table of one row per key and range: the last row before the
cut (as-of join), the last time and the number of sessions before it (sessions), or the cuts that a row
still reaches (frames, whose rows before the cut are copied as a halo).  The interval join needs no
order: it meets rows in bins of the axis and lets each pair through in one bin only.

Times are timestamps, dates or whole numbers; widths, gaps and tolerances are in microseconds for the
first two and in the axis' unit for numbers.  Rows whose time is null match nothing and belong to no
frame; rows whose key is null are a key of their own in frames and sessions and match nothing in joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.operators.windows import ordered_ranges
from rideflow.sources.sinks import materialize

HOUR = 3_600_000_000
DAY = 24 * HOUR


def time_axis(df: DataFrame, col: str) -> Column:
    """``col`` as a whole number: microseconds of timestamps and dates, integers as they are."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    raise ValueError(f"{col} is {kind.simpleString()}: not a timestamp, a date or a whole number")


def _struct(df: DataFrame, extra: Sequence[Column] = ()) -> Column:
    return F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`").alias(c) for c in df.columns], *extra)


def _key_names(n: int) -> list[str]:
    return [f"_key{i}" for i in range(n)]


def _same_range(edges: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Column]:
    """``edges`` with its key and range columns renamed, and the condition that joins rows to it."""
    renamed = edges.withColumnsRenamed({c: f"_of{c}" for c in [*names, "_bucket"]})
    cond = F.col("_bucket") == F.col("_of_bucket")
    for c in names:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_of{c}"))
    return renamed, cond


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    left_time: str,
    right_time: str,
    columns: Mapping[str, str],
    *,
    right_order: Sequence[str] = (),
    tolerance: int | None = None,
    how: str = "left",
    buckets: int | None = None,
) -> DataFrame:
    """Each row of ``left`` with the latest row of ``right`` of equal keys at or before its time.

    ``keys`` maps key columns of ``left`` to those of ``right`` (a list: the same names); ``columns``
    maps output names to columns of ``right``.  Of several right rows of one time the last by
    ``right_order`` counts.  A match older than ``tolerance`` is none.  ``how="inner"`` leaves out rows
    without a match.  The two tables are sorted together once; nothing is broadcast by hand.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown how {how!r}")
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    names = _key_names(len(pairs))
    clash = [c for c in columns if c in left.columns]
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")

    payload = F.struct(F.lit(True).alias("_"), time_axis(right, right_time).alias("_time"), *[F.col(f"`{c}`").alias(o) for o, c in columns.items()])
    ties = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in right_order])
    tie_type = right.select(ties.alias("t")).schema["t"].dataType
    earlier = right.select(
        *[F.col(f"`{r}`").alias(n) for r, n in zip(pairs.values(), names)],
        time_axis(right, right_time).alias("_at"),
        F.lit(0).alias("_side"),
        ties.alias("_tie"),
        payload.alias("_right"),
    ).filter(F.col("_at").isNotNull())
    for n in names:
        earlier = earlier.filter(F.col(n).isNotNull())
    later = left.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(pairs, names)],
        time_axis(left, left_time).alias("_at"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(tie_type).alias("_tie"),
        _struct(left).alias("_left"),
    )
    both = earlier.unionByName(later, allowMissingColumns=True)
    order = ["_at", "_side", "_tie"]
    ranged = ordered_ranges(both, names, order, buckets)
    so_far = Window.partitionBy(*names, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.withColumn("_right", F.last("_right", ignorenulls=True).over(so_far)).filter(F.col("_side") == 1)
    # The last right row of each key and range, and for every range that of the ranges before it.
    ends = ranged.groupBy(*names, "_bucket").agg(F.max(F.when(F.col("_side") == 0, F.struct("_at", "_tie", "_right"))).alias("_end"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*names, "_bucket", F.last("_end._right", ignorenulls=True).over(before).alias("_carried"))
    carried, cond = _same_range(carried.filter(F.col("_carried").isNotNull()), names)
    found = rows.join(carried, cond, "left").withColumn("_right", F.coalesce("_right", "_carried"))
    fits = F.col("_at").isNotNull() & F.col("_right").isNotNull()
    for n in names:
        fits = fits & F.col(n).isNotNull()
    if tolerance is not None:
        fits = fits & (F.col("_at") - F.col("_right._time") <= F.lit(tolerance))
    if how == "inner":
        found = found.filter(fits)
    return found.select(
        *[F.col("_left")[c].alias(c) for c in left.columns], *[F.when(fits, F.col("_right")[o]).alias(o) for o in columns]
    )


#: Each level's bins are so many times as wide as those of the level below.
_STEP = 8


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_interval: tuple[str, str],
    right_interval: tuple[str, str],
    keys: Mapping[str, str] | Sequence[str] = (),
    *,
    width: int | None = None,
) -> DataFrame:
    """The pairs of rows whose closed intervals overlap and whose ``keys`` are equal.

    An interval is (start, end); a point names one column twice.  Rows with a null bound, or that end
    before they start, match nothing.  The two tables' column names must differ.

    The axis is cut into bins of ``width`` (default: the mean length) and, for longer intervals, of 8,
    64, ... times that, so that an interval touches a few bins of its own level however long it is.
    Rows meet in the bins of the coarser of their two levels, by an equi-join that Spark may broadcast,
    sort or split where a bin is hot, and a pair counts only in the bin where the later one starts.
    """
    clash = sorted(set(left.columns) & set(right.columns))
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    names = _key_names(len(pairs))

    def placed(df: DataFrame, interval: tuple[str, str], key_cols: Sequence[str]) -> DataFrame:
        a, b = (time_axis(df, c) for c in interval)
        rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, names)], a.alias("a"), b.alias("b"), _struct(df).alias("row"))
        return rows.filter("a <= b")

    sides = placed(left, left_interval, list(pairs)), placed(right, right_interval, list(pairs.values()))
    if width is None:
        mean = sides[0].select("a", "b").unionByName(sides[1].select("a", "b")).agg(F.avg(F.col("b") - F.col("a")).alias("m")).first().m
        width = max(int(mean or 0), 1)
    level = F.greatest(F.ceil(F.log((F.col("b") - F.col("a") + 1) / F.lit(width)) / F.log(F.lit(float(_STEP)))), F.lit(0)).cast("int")
    sides = [s.withColumn("own", level) for s in sides]
    # At most 22 numbers a side.
    levels = [sorted(r.own for r in s.select("own").distinct().collect()) for s in sides]

    def binned(rows: DataFrame, others: list[int], tag: str) -> DataFrame:
        wanted = F.filter(F.array(*[F.lit(x) for x in others]).cast("array<int>"), lambda x: x > F.col("own"))
        if others:  # a row's own level is of use if the other side has rows of that level or below
            wanted = F.when(F.col("own") >= others[0], F.array_append(wanted, F.col("own"))).otherwise(wanted)
        at = rows.withColumn("level", F.explode(wanted))
        size = F.pow(F.lit(_STEP), F.col("level")).cast("long") * F.lit(width)
        bins = F.sequence(F.expr("floor(a / size)"), F.expr("floor(b / size)"))
        at = at.withColumn("size", size).withColumn("bin", F.explode(bins))
        return at.withColumnsRenamed({c: f"{tag}_{c}" for c in at.columns})

    l, r = binned(sides[0], levels[1], "l"), binned(sides[1], levels[0], "r")
    cond = (F.col("l_level") == F.col("r_level")) & (F.col("l_bin") == F.col("r_bin"))
    for n in names:
        cond = cond & (F.col(f"l_{n}") == F.col(f"r_{n}"))
    cond = cond & (F.col("l_a") <= F.col("r_b")) & (F.col("r_a") <= F.col("l_b"))
    cond = cond & (F.greatest("l_own", "r_own") == F.col("l_level"))
    cond = cond & (F.col("l_bin") == F.floor(F.greatest("l_a", "r_a") / F.col("l_size")))
    joined = l.join(r, cond)
    return joined.select(*[F.col("l_row")[c].alias(c) for c in left.columns], *[F.col("r_row")[c].alias(c) for c in right.columns])


def frame_aggregates(
    df: DataFrame,
    aggregates: Mapping[str, Column],
    keys: str | Sequence[str],
    time: str,
    preceding: int,
    *,
    buckets: int | None = None,
) -> DataFrame:
    """``df`` with aggregates over the rows of the same keys from ``preceding`` before its time up to it.

    ``aggregates`` maps output names to aggregate columns (``F.sum("x")``, ``F.max("x")``, ...); rows of
    the row's own time belong to the frame, as in ``RANGE BETWEEN n PRECEDING AND CURRENT ROW``.  Rows
    whose time is null get null.  Each range also gets the rows of earlier ranges that its frames reach,
    so a range of a hot key holds its own rows and the rows of one frame.
    """
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    names = _key_names(len(key_cols))
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, names)], time_axis(df, time).alias("_at"), _struct(df).alias("_row"))
    ranged = ordered_ranges(rows, names, ["_at"], buckets).withColumn("_own", F.lit(True))
    timed = ranged.filter(F.col("_at").isNotNull())
    # One row per key and range: where its times begin and end.
    cuts = materialize(timed.groupBy(*names, "_bucket").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last")), label="range-cuts")
    after, _ = _same_range(cuts, names)
    reach = F.col("_of_bucket") > F.col("_bucket")
    for n in names:
        reach = reach & F.col(n).eqNullSafe(F.col(f"_of{n}"))
    after = after.withColumnsRenamed({"_first": "_next_first", "_last": "_next_last"})
    reached = cuts.join(after, reach & (F.col("_next_first") - F.lit(preceding) <= F.col("_last")))
    reached = reached.groupBy(*names, "_bucket").agg(F.collect_list(F.struct(F.col("_of_bucket").alias("to"), (F.col("_next_first") - F.lit(preceding)).alias("since"))).alias("_to"))
    reached, cond = _same_range(reached, names)
    halo = timed.join(reached, cond).select(*names, "_at", "_row", F.explode("_to").alias("_to")).filter(F.col("_at") >= F.col("_to.since"))
    halo = halo.select(*names, "_at", "_row", F.col("_to.to").alias("_bucket"), F.lit(False).alias("_own"))
    frame = Window.partitionBy(*names, "_bucket").orderBy("_at").rangeBetween(-preceding, Window.currentRow)
    whole = timed.unionByName(halo).select(*names, "_at", "_bucket", "_own", "_row", "_row.*")
    # Names of the table stand for its columns inside the aggregates; the rest stays in the struct.
    found = whole.select("_own", "_row", *[a.over(frame).alias(f"_out{i}") for i, a in enumerate(aggregates.values())]).filter("_own")
    untimed = ranged.filter(F.col("_at").isNull()).select("_own", "_row")
    found = found.unionByName(untimed, allowMissingColumns=True)
    outs = [F.col(f"_out{i}").alias(o) for i, o in enumerate(aggregates)]
    return found.select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in aggregates], *outs)


def sessions(
    df: DataFrame,
    keys: str | Sequence[str],
    time: str,
    gap: int,
    *,
    order: Sequence[str] = (),
    out: str = "session",
    buckets: int | None = None,
) -> DataFrame:
    """``df`` with the number, from 1, of each row's session among those of its keys.

    A session ends where the next row is more than ``gap`` later.  ``order`` breaks ties of time for the
    cuts only; rows of one time are always in one session.  Rows whose time is null get null.
    """
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    names = _key_names(len(key_cols))
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key_cols, names)], time_axis(df, time).alias("_at"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in order]).alias("_tie"), _struct(df).alias("_row"))
    ranged = ordered_ranges(rows, names, ["_at", "_tie"], buckets)
    timed = ranged.filter(F.col("_at").isNotNull())
    within = Window.partitionBy(*names, "_bucket").orderBy("_at", "_tie")
    # Starts inside a range; its first row waits for the range before.
    starts = timed.withColumn("_start", F.coalesce((F.col("_at") - F.lag("_at").over(within) > F.lit(gap)).cast("long"), F.lit(0)))
    counted = starts.withColumn("_local", F.sum("_start").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = materialize(
        starts.groupBy(*names, "_bucket").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.sum("_start").alias("_inside")),
        label="range-ends",
    )
    along = Window.partitionBy(*names).orderBy("_bucket")
    opens = F.coalesce((F.col("_first") - F.lag("_last").over(along) > F.lit(gap)).cast("long"), F.lit(0))
    opened = ends.withColumn("_opens", opens)
    before = F.coalesce(F.sum("_inside").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    up_to = F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = opened.select(*names, "_bucket", (before + up_to + 1).alias("_offset"))
    offsets, cond = _same_range(offsets, names)
    found = counted.join(offsets, cond, "left").select("_row", (F.col("_local") + F.col("_offset")).alias(out))
    found = found.unionByName(ranged.filter(F.col("_at").isNull()).select("_row"), allowMissingColumns=True)
    return found.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != out], out)


def session_lengths(df: DataFrame, keys: str | Sequence[str], time: str, gap: int, *, buckets: int | None = None) -> DataFrame:
    """One row per session: keys, session, start, end, and the number of rows ``n``."""
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    numbered = sessions(df.select(*key_cols, time), key_cols, time, gap, out="session", buckets=buckets).filter("session IS NOT NULL")
    return numbered.groupBy(*key_cols, "session").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n"))
