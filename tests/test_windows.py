import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rideflow.operators import nested, windows


def _series(spark, rows):
    return spark.createDataFrame(rows, "k string, pos int, v decimal(12,2)")


@pytest.mark.parametrize("buckets", [None, 1, 3, 7, "auto"])
def test_running_sum_bucketed_equals_plain(spark, buckets):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        k = rnd.choice(["hot"] * 6 + ["a", "b", None])
        v = None if rnd.random() < 0.1 else Decimal(rnd.randint(-300, 900)) / 100
        rows.append((k, i, v))
    df = _series(spark, rows)
    got = {
        (r.k, r.pos): r.running_sum for r in windows.running_sum(df, "v", "k", ["pos"], buckets=buckets).collect()
    }
    expected, acc = {}, {}
    for k, pos, v in sorted(rows, key=lambda r: r[1]):
        if v is not None:
            acc[k] = acc.get(k, Decimal(0)) + v
        expected[(k, pos)] = acc.get(k)
    assert got == expected


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_running_sum_of_a_wide_table(spark, tmp_path, reuse):
    """Columns outside keys and order, a hot key, a hot value of the first order column."""
    rows = spark.range(120_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 5) END AS k",
        "CASE WHEN id % 2 = 0 THEN 7 ELSE hash(id) % 50 END AS day",
        "id", "CAST(hash(id, 1) % 1000 AS DECIMAL(18,2)) AS v", "concat('payload ', id) AS payload",
    )
    rows.repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plain = windows.running_sum(df, "v", "k", ["day", "id"])
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        for buckets in (8, 32):
            ranged = windows.running_sum(df, "v", "k", ["day", "id"], buckets=buckets)
            assert ranged.schema == plain.schema
            assert ranged.exceptAll(plain).isEmpty() and plain.exceptAll(ranged).isEmpty()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_running_sum_in_sparks_own_sum_type(spark):
    big = spark.range(200).selectExpr("'k' AS k", "CAST(id AS INT) AS pos", "CAST(9000000000000000 AS DECIMAL(18,2)) AS v")
    for buckets in (None, 4):
        out = windows.running_sum(big, "v", "k", ["pos"], buckets=buckets)
        assert out.agg({"running_sum": "max"}).first()[0] == 200 * 9_000_000_000_000_000
    swing = spark.range(8).selectExpr("'k' AS k", "CAST(id AS INT) AS pos", "IF(id < 2 OR id > 5, 1, -1) * CAST(pow(2, 61) AS BIGINT) AS v")
    want = [r.running_sum for r in windows.running_sum(swing, "v", "k", ["pos"]).orderBy("pos").collect()]
    got = windows.running_sum(swing, "v", "k", ["pos"], buckets=4)
    assert [r.running_sum for r in got.orderBy("pos").collect()] == want
    assert dict(got.dtypes)["running_sum"] == "bigint"


def _reach(spark, values, mode):
    df = _series(spark, [("k", i, Decimal(str(v))) for i, v in enumerate(values)])
    rows = windows.rows_to_reach(df, "v", "k", ["pos"], 5, mode=mode, buckets=2).collect()
    return rows[0].rows_count if rows else "absent"


def test_rows_to_reach_reference_mode(spark):
    assert _reach(spark, [2, 2, 1, 3], "reference") == 3  # hits 5 exactly
    assert _reach(spark, [2, 2.95, 0.07, 1], "reference") is None  # jumps over 5
    assert _reach(spark, [1, 1, 1], "reference") is None  # never reaches it
    assert _reach(spark, [6, 1], "reference") == "absent"  # no row kept at all
    assert _reach(spark, [3, 2, 0, 0, 1], "reference") == 4  # zero rows at the total count


def test_rows_to_reach_first_crossing(spark):
    assert _reach(spark, [2, 2.95, 0.07, 1], "first_crossing") == 3
    assert _reach(spark, [1, 1, 1], "first_crossing") is None
    assert _reach(spark, [6, -3, 1], "first_crossing") == 1
    assert _reach(spark, [4, -3, 2, 3], "first_crossing") == 4


def test_latest_n_and_array_order(spark):
    df = spark.createDataFrame(
        [(1, t, float(t)) for t in range(10)] + [(2, 1, 100.0)], "zone int, t int, pay double"
    )
    top = windows.latest_n(df, "zone", [F.desc("t")], 3)
    assert sorted((r.zone, r.t, r.row_number) for r in top.collect()) == [
        (1, 7, 3), (1, 8, 2), (1, 9, 1), (2, 1, 1)
    ]
    arr = {r.zone: r.payloads for r in windows.latest_n_array(df, "zone", [F.desc("t")], "pay", 5).collect()}
    assert arr == {1: [9.0, 8.0, 7.0, 6.0, 5.0], 2: [100.0]}
    third = windows.latest_n_array(df, "zone", [F.desc("t")], "pay", 5).select(
        "zone", nested.nth_element("payloads", 2).alias("third")
    )
    assert {r.zone: r.third for r in third.collect()} == {1: 7.0, 2: None}


def test_first_n_daily(spark):
    df = spark.sql(
        "SELECT 1 AS loc, CAST(t AS TIMESTAMP) AS ts, id FROM VALUES "
        "('2018-02-04 10:00:00', 1), ('2018-02-04 09:00:00', 2), ('2018-02-04 11:00:00', 3), "
        "('2018-02-05 00:00:00', 4) AS v(t, id)"
    )
    kept = windows.first_n_daily(df, "loc", "ts", 2, ["id"])
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4]


def test_hot_key_spans_many_ranges(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i % 50}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, pos int")
    ranged = windows.ordered_ranges(df, ["k"], ["pos"], 12)
    per_key = {r.k: r.n for r in ranged.groupBy("k").agg(F.countDistinct("_bucket").alias("n")).collect()}
    assert per_key["hot"] >= 3
    # ranges are contiguous and increasing in the order within a key
    hot = sorted((r.pos, r._bucket) for r in ranged.filter("k = 'hot'").collect())
    buckets = [b for _, b in hot]
    assert buckets == sorted(buckets)


def test_running_sum_with_coarse_buckets(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice(["hot", "hot", "a", None]), i, Decimal(rnd.randint(-50, 90)) / 10) for i in range(300)]
    df = _series(spark, rows)
    plain = {(r.k, r.pos): r.running_sum for r in windows.running_sum(df, "v", "k", ["pos"]).collect()}
    coarse = windows.running_sum(df, "v", "k", ["pos"], bucket_by=F.floor(F.col("pos") / 40))
    assert {(r.k, r.pos): r.running_sum for r in coarse.collect()} == plain
    reach = windows.rows_to_reach(df, "v", "k", ["pos"], 5, mode="first_crossing", bucket_by=F.floor(F.col("pos") / 40))
    plain_reach = windows.rows_to_reach(df, "v", "k", ["pos"], 5, mode="first_crossing")
    assert sorted(map(tuple, reach.collect()), key=str) == sorted(map(tuple, plain_reach.collect()), key=str)
