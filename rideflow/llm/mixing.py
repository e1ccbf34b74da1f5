"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight schedule over the training run, a piecewise-linear curve of
``(time, weight)`` knots with time in [0, 1].  The integral of the curve is the source's weight in
the mix.  A document copy that begins after ``c`` words of its source's stream is wanted at the time
at which the source's cumulative demand reaches ``c``; that time is its training position, and
documents are range-sorted by it.

Only DataFrame functions are used.  Running word counts are two-level: a source is cut into hash
buckets in the order of the hash, bucket totals are summed per source, and each bucket is summed on
its own, so a source holding a third of all rows spreads over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rideflow.sources import materialize

#: A word is a run of characters other than space, tab, newline and their like.
WORD = r"[^\x20\x09-\x0D]+"

Schedule = Sequence[tuple[float, float]]

#: Weights 3, 1 and 2: steady, falling (early in training) and rising (late in training).
CURRICULUM: tuple[Schedule, ...] = (
    ((0.0, 3.0), (1.0, 3.0)),
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 3.0)),
)


def schedule_weight(schedule: Schedule) -> Fraction:
    """The integral of a piecewise-linear schedule over [0, 1]."""
    knots = [(Fraction(t).limit_denominator(10**6), Fraction(w).limit_denominator(10**6)) for t, w in schedule]
    return sum(((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:])), Fraction(0))


def invert_demand(share: Column, schedule: Schedule) -> Column:
    """The time at which a source has met ``share`` (0 to 1) of its whole demand."""
    total = float(schedule_weight(schedule))
    done, out = 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area = (w0 + w1) / 2 * (t1 - t0)
        rest = F.greatest(share * F.lit(total) - F.lit(done), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        # rest = w0 x + slope x^2 / 2, solved in the form that does not cancel.
        at = F.lit(t0) + F.when(rest > 0, F.lit(2.0) * rest / (F.lit(w0) + root)).otherwise(F.lit(0.0))
        last = area + done >= total - 1e-12
        out = (F if out is None else out).when(F.lit(True) if last else share * F.lit(total) < F.lit(done + area), at)
        done += area
        if last:
            break
    return F.least(out, F.lit(1.0))


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule], share: Fraction, max_repeat: int) -> DataFrame:
    """One row per source: rank, size, rows, target (water-filling below ``max_repeat`` x size).

    The table has a row per *source* (a mix names its sources), so its windows are small.  All
    arithmetic up to the last division is exact.
    """
    weights = [schedule_weight(s) for s in schedules]
    scale = lcm(*(w.denominator for w in weights))
    ints = [int(w * scale) for w in weights]
    if min(ints) <= 0:
        raise ValueError("every schedule needs a positive integral")
    common = lcm(*ints)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_room = Window.orderBy("room", "rank")
    dec = "decimal(26,0)"
    slots = F.array(*[F.lit(w) for w in ints])
    rows = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("slot", F.col("rank") % len(ints))
        .withColumn("weight", F.get(slots, F.col("slot")))
        # room: how far the common level may rise before this source is full, times a constant.
        .withColumn("room", F.col("source_size").cast(dec) * (F.lit(common) / F.col("weight")).cast("int"))
        .withColumn("total", F.sum("source_size").over(everything).cast(dec))
        .withColumn("filled", F.coalesce(F.sum(F.col("source_size").cast(dec)).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(dec))
        .withColumn("rivals", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(12,0)"))
    )
    # Level of the rest once the sources before this one are full: left / rivals.
    left = F.col("total") * share.numerator - F.col("filled") * (max_repeat * share.denominator)
    full = left * F.col("weight") >= F.col("source_size").cast(dec) * F.col("rivals") * (max_repeat * share.denominator)
    level = F.when(~F.col("full"), F.struct("room", "rank", "left", "rivals"))
    return (
        rows.withColumn("left", left)
        .withColumn("full", full)
        .withColumn("level", F.min(level).over(everything))
        .withColumn("open", F.col("level").isNotNull() & (F.struct("room", "rank") >= F.struct("level.room", "level.rank")))
        .withColumn(
            "target",
            F.when(
                F.col("open"),
                (F.col("level.left") * F.col("weight")).cast("double")
                / (F.col("level.rivals") * share.denominator).cast("double"),
            ).otherwise((F.col("source_size") * max_repeat).cast("double")),
        )
        .select("source", "rank", "slot", "source_size", "n_docs", "target")
    )


def mix_sources(
    docs: DataFrame,
    schedules: Sequence[Schedule] = CURRICULUM,
    *,
    share: Fraction = Fraction(3, 2),
    max_repeat: int = 2,
    bucket_rows: int = 2000,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, taken and its training positions.

    Sources take the schedules in turn, in code point order with null last.  The mix is ``share``
    times all words; a source gives at most ``max_repeat`` times its words.  A source's words are
    read in hash order of doc_id, again and again until its target is met; ``taken`` is how many
    words of the document that reads (the document at the end gives the words still wanted).
    ``position`` is the time of the first copy (null if none is taken), ``last_position`` that of the
    last.  Sorted by position, then doc_id.

    Nulls: a null text has size 0; a null source is a source; null doc_ids share one place in the
    order.  Sizes of 0 are never taken.  Repeated rows count as often as they occur.  An empty table
    gives no rows.  Other columns are carried along (``carry`` names those wanted); columns of the
    same names as the results are replaced.
    """
    made = ["size", "source_size", "target", "taken", "position", "last_position"]
    carried = [c for c in (docs.columns if carry is None else carry) if c not in made]
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    row = F.struct(*[F.col(f"`{c}`") for c in carried])
    sized = docs.select(
        row.alias("row"),
        F.col("doc_id").alias("id"),
        F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest.alias("place"),
    )
    sized = materialize(sized, label="mix-sizes")
    targets = materialize(source_targets(sized, schedules, share, max_repeat), label="mix-targets")

    known = targets.withColumnRenamed("source", "of")
    n_buckets = F.ceil(F.col("n_docs") / F.lit(bucket_rows)).cast("long")
    cut = F.shiftright(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * n_buckets, 32)
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", cut).drop("of", "source")
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("rank", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("rank", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    )
    starts = materialize(starts, label="mix-buckets")
    inside = Window.partitionBy("rank", "bucket").orderBy("place", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.floor(F.col("target") + 0.5).cast("long")
    rounds = F.coalesce(F.try_divide(wanted, F.col("source_size")).cast("long"), F.lit(0))
    rest = F.col("wanted") - F.col("rounds") * F.col("source_size")
    taken = F.col("rounds") * F.col("size") + F.greatest(F.least(rest - F.col("offset"), F.col("size")), F.lit(0))
    copies = F.ceil(F.col("taken") / F.col("size"))
    where = {}
    for name, before_words in (("position", F.lit(0)), ("last_position", (copies - 1) * F.col("source_size"))):
        part = (before_words + F.col("offset")).cast("double") / F.col("target")
        choice = F
        for slot, schedule in enumerate(schedules):
            choice = choice.when((F.col("slot") == slot) & (F.col("taken") > 0), invert_demand(part, schedule))
        where[name] = choice
    return (
        placed.join(starts, ["rank", "bucket"])
        .withColumn("offset", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("wanted", wanted)
        .withColumn("rounds", rounds)
        .withColumn("taken", taken)
        .withColumns(where)
        .select(F.col("row.*"), *made)
        .orderBy(F.col("position").asc_nulls_last(), *[F.col(c) for c in ("doc_id",) if c in carried])
    )
