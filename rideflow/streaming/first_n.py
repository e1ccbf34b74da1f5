"""Deduplication and the first n rows per key and day on a stream (G7 and W2 with state).

The state of a key and day is the n first distinct rows seen so far, at most n however hot the key.
Keys are dealt into a fixed number of buckets, and the keys of a bucket and day share one packed state:
the calls of Python grow with buckets and days, not with keys.
Rows that are given again equal one that is kept, or come after the last kept one, so that the full-row
distinct needs no state of its own.  A day is given out once, when the watermark has passed its end;
later rows of that day are dropped, as are rows without an event time.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from heapq import nsmallest

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rideflow.session import scratch_path

_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: JSON of the key, and for each key its kept rows in order: [time, tie, content].
_STATE = "packed binary"
_DAY_MS = 24 * 3600 * 1000


def _load(state: GroupState) -> dict[str, list]:
    return json.loads(zlib.decompress(state.get[0]))


def _keep_first(n: int):
    """Merge the rows of a bucket and day into its state; give them out when the day is over."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            rows = [(packed, nth) for kept in _load(state).values() for nth, (_, _, packed) in enumerate(kept, 1)]
            state.remove()
            yield pd.DataFrame(rows, columns=["packed", "nth"])
            return
        day_end = (int(key[-1]) + 1) * _DAY_MS
        kept = {k: set(map(tuple, rows)) for k, rows in _load(state).items()} if state.exists else {}
        for frame in frames:
            touched = set()
            for of, row in zip(frame["_of"], zip(frame["_at"].tolist(), frame["_tie"].tolist(), frame["_packed"])):
                kept.setdefault(of, set()).add(row)
                touched.add(of)
            for of in touched:
                if len(kept[of]) > n:
                    kept[of] = set(nsmallest(n, kept[of]))
        if day_end <= state.getCurrentWatermarkMs() or not kept:
            return
        rows = json.dumps({of: sorted(rows) for of, rows in kept.items()})
        state.update((zlib.compress(rows.encode(), 1),))
        state.setTimeoutTimestamp(day_end)

    return run


def _key_text(stream: DataFrame, keys: Sequence[str]) -> Column:
    """The keys as one string that is the same for the same group: zeros of either sign are one."""
    kinds = dict(stream.dtypes)
    cols = []
    for i, k in enumerate(keys):
        col = F.col(k)
        if kinds.get(k) in ("float", "double"):
            col = F.when(col == 0, F.lit(0.0).cast(kinds[k])).otherwise(col)
        cols.append(col.alias(f"_{i}"))
    return F.to_json(F.struct(*cols), _FORMATS)


def first_n_per_day(
    stream: DataFrame, keys: str | Sequence[str], ts_col: str, n: int, *, tie: str | None = None, lateness: str = "1 hour",
    buckets: int = 128,
) -> DataFrame:
    """The distinct rows of ``stream`` that are among the first ``n`` of their keys and calendar day (UTC)
    by ``ts_col``, with their place ``nth``.

    Rows of one time are ordered by ``tie``, a whole-number column (null first), and then by their
    content.  Null keys are a group like any other.  Rows may come late by ``lateness``; the stream
    must not have a column ``nth``.  ``buckets`` is part of the state: a run that goes on with a
    checkpoint needs the number it began with.
    """
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    if "nth" in stream.columns:
        raise ValueError("the stream has a column nth already")
    # A timestamp without a time zone carries no watermark; it is taken as one in the session's zone.
    timed = stream.filter(F.col(ts_col).isNotNull()).withColumn("_time", F.col(ts_col).cast("timestamp"))
    timed = timed.withWatermark("_time", lateness)
    at = F.unix_micros("_time")
    lowest = F.lit(-(1 << 63)).cast("bigint")
    packed = timed.select(
        "_time",
        _key_text(timed, key_cols).alias("_of"),
        F.floor(at / F.lit(_DAY_MS * 1000)).cast("bigint").alias("_day"),
        at.alias("_at"),
        (F.coalesce(F.col(tie).cast("bigint"), lowest) if tie else F.lit(0).cast("bigint")).alias("_tie"),
        F.to_json(F.struct(*stream.columns), _FORMATS).alias("_packed"),
    )
    packed = packed.withColumn("_bucket", F.pmod(F.xxhash64("_of"), F.lit(buckets)))
    first = packed.groupBy("_bucket", "_day").applyInPandasWithState(
        _keep_first(n), "packed string, nth bigint", _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema.fields])
    return first.select(F.from_json("packed", schema, _FORMATS).alias("row"), "nth").select("row.*", "nth")


def stream_first_n(
    stream: DataFrame, keys: str | Sequence[str], ts_col: str, n: int, *, sink_root: str | None = None, **more
) -> DataFrame:
    """Run ``first_n_per_day`` until caught up and read what was given out so far.

    State, checkpoint and sink live below ``spark.checkpoint.dir``; the same ``sink_root`` again goes on
    where the last run stopped, with the open days of its state, and writes no row twice.
    """
    first = first_n_per_day(stream, keys, ts_col, n, **more)
    root = sink_root or scratch_path(stream.sparkSession, "first-n")
    running = (
        first.writeStream.format("parquet")
        .option("path", f"{root}/data")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return stream.sparkSession.read.schema(first.schema).parquet(f"{root}/data")
