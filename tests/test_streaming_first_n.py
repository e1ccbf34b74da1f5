import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rideflow.session import scratch_path
from rideflow.sources.tables import TABLE_SCHEMAS, table
from rideflow.streaming.events import file_stream
from rideflow.streaming.first_n import first_n_per_day, stream_first_n

SF = "/root/testdata/sf0.001"
ROWS = "id long, ts timestamp, zone string, fare double"


def _at(day, hour, minute=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, 0, micro)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _drop_in(spark, root, rows):
    """One more file in the stream's folder."""
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_equal_to_the_window_over_all_closed_days(spark):
    streamed = stream_first_n(file_stream(spark, f"{SF}/events.parque[t]", TABLE_SCHEMAS["events"]), "user_id", "ts", 3, tie="event_id")
    events = table(spark, SF, "events").distinct()
    closed = events.agg(F.date_trunc("day", F.max("ts") - F.expr("INTERVAL 1 HOUR"))).first()[0]
    order = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    want = events.withColumn("nth", F.row_number().over(order).cast("long")).filter(F.col("nth") <= 3)
    assert _rows(streamed) == _rows(want.filter(F.col("ts") < F.lit(closed)))
    assert streamed.count() > 0


def test_restart_goes_on_with_open_days_and_drops_late_rows(spark):
    root = scratch_path(spark, "first-n-test")
    big = (1 << 53) + 1
    _drop_in(spark, root, [(big, _at(1, 9, micro=7), "a", 1.5), (2, _at(1, 8), "a", None), (3, _at(1, 10), "a", 2.0),
                           (2, _at(1, 8), "a", None), (5, _at(1, 9), None, 0.1), (6, None, "a", 1.0), (7, _at(1, 9), "b", 3.0)])

    def run():
        return _rows(stream_first_n(file_stream(spark, f"{root}/in", spark.createDataFrame([], ROWS).schema), "zone", "ts", 2, tie="id", sink_root=f"{root}/out"))

    assert run() == []
    # A day that was open when the run ended takes a row that comes first, and a repeated one.
    _drop_in(spark, root, [(8, _at(1, 23, 50), "b", 4.0), (9, _at(1, 22), "b", 5.0), (7, _at(1, 9), "b", 3.0)])
    assert run() == []
    _drop_in(spark, root, [(10, _at(2, 12), "a", 9.0)])
    day_one = [(2, _at(1, 8), "a", None, 1), (big, _at(1, 9, micro=7), "a", 1.5, 2), (5, _at(1, 9), None, 0.1, 1),
               (7, _at(1, 9), "b", 3.0, 1), (9, _at(1, 22), "b", 5.0, 2)]
    assert run() == sorted(day_one, key=repr)
    # Too late for day one; nothing is given out twice.
    _drop_in(spark, root, [(11, _at(1, 1), "a", 0.0)])
    assert run() == run() == sorted(day_one, key=repr)
    _drop_in(spark, root, [(12, _at(4, 12), "c", 0.0)])
    assert run() == sorted(day_one + [(10, _at(2, 12), "a", 9.0, 1)], key=repr)


def test_clashing_column(spark):
    with pytest.raises(ValueError):
        first_n_per_day(spark.createDataFrame([], "ts timestamp, nth int"), "nth", "ts", 1)


def test_keys_of_a_bucket_share_calls_and_state(spark, monkeypatch):
    from rideflow.streaming import first_n

    calls = scratch_path(spark, "first-n-calls").removeprefix("file:")
    keep = first_n._keep_first

    def counted(n):
        run = keep(n)

        def wrapped(key, frames, state):
            import os

            os.makedirs(calls, exist_ok=True)
            open(f"{calls}/{key}-{state.hasTimedOut}", "w").close()
            yield from run(key, frames, state)

        return wrapped

    monkeypatch.setattr(first_n, "_keep_first", counted)
    root = scratch_path(spark, "first-n-test")
    rows = [(i, _at(1, 9, i % 60), f"k{i % 150}", 1.0) for i in range(600)] + [(600, _at(1, 9), None, 1.0), (601, _at(1, 8), None, 1.0), (602, _at(3, 1), "k1", 1.0)]
    _drop_in(spark, root, rows)
    stream = file_stream(spark, f"{root}/in", spark.createDataFrame([], ROWS).schema)
    first = first_n.first_n_per_day(stream, "zone", "ts", 2, tie="id", buckets=2)
    first.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start().awaitTermination()
    want = []
    for key in {r[2] for r in rows}:
        own = sorted((r for r in rows[:-1] if r[2] == key), key=lambda r: (r[1], r[0]))[:2]
        want += [(*r, i) for i, r in enumerate(own, 1)]
    assert _rows(spark.read.schema(first.schema).parquet(f"{root}/out")) == sorted(want, key=repr)
    import os

    assert len(os.listdir(calls)) <= 5  # two buckets of a day: rows and end; a bucket of the open day


def test_zeros_of_either_sign_are_one_key(spark):
    root = scratch_path(spark, "first-n-test")
    _drop_in(spark, root, [(1, _at(1, 9), "a", -0.0), (2, _at(1, 8), "a", 0.0), (3, _at(1, 10), "a", float("nan")), (4, _at(3, 1), "a", 1.0)])
    found = stream_first_n(file_stream(spark, f"{root}/in", spark.createDataFrame([], ROWS).schema), "fare", "ts", 2, tie="id")
    assert sorted((r.id, r.nth) for r in found.collect()) == [(1, 2), (2, 1), (3, 1)]
