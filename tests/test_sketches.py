import pytest
from pyspark.sql import functions as F

from rideflow.operators.sketches import merge_states, read_states, sketch_states
from rideflow.sources import materialize


def _rank(values, x):
    return sum(v <= x for v in values) / len(values)


def test_merged_states_are_near_the_exact_answer(spark):
    # A third of all rows and more are of one day.
    rows = spark.range(60000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 30).alias("day"),
        (F.col("id") % 7000).alias("who"), ((F.col("id") * 7919) % 60013).cast("double").alias("fare"))
    days = materialize(sketch_states(rows, ["day"], "who", "fare"), label="states")
    assert {r.day: r.n for r in days.collect()} == {r.day: r["count"] for r in rows.groupBy("day").count().collect()}
    weeks = merge_states(days.withColumn("week", F.floor(F.col("day") / 7)), ["week"])
    whole = read_states(merge_states(weeks, []), {"median": 0.5, "p99": 0.99}).first()
    fares = [r.fare for r in rows.collect()]
    assert whole.n == 60000 and abs(whole.n_distinct - 7000) <= 0.03 * 7000
    assert abs(_rank(fares, whole.median) - 0.5) <= 0.02 and abs(_rank(fares, whole.p99) - 0.99) <= 0.02


def test_nulls_nan_ties_empty_tables_and_other_types(spark):
    schema = "key string, day date, x double"
    rows = [("a", None, None), ("a", None, float("nan")), (None, None, 5.0), (None, None, 5.0), ("b", None, 1.0), ("b", None, 2.0)]
    frame = spark.createDataFrame(rows, schema).withColumn("day", F.when(F.col("key") == "b", F.lit("2024-01-01").cast("date")))
    got = read_states(sketch_states(frame, ["key"], "day", "x"), {"least": 0.0, "most": 1.0})
    assert {tuple(r) for r in got.collect()} == {("a", 2, 0, None, None), (None, 2, 0, 5.0, 5.0), ("b", 2, 1, 1.0, 2.0)}
    none = spark.createDataFrame([], schema)
    assert sketch_states(none, ["key"], "day", "x").count() == 0
    assert tuple(read_states(sketch_states(none, [], "day", "x"), {"m": 0.5}).first()) == (0, 0, None)
    with pytest.raises(ValueError):
        sketch_states(frame.withColumnRenamed("key", "n"), ["n"], "day", "x")
