import datetime as dt

from pyspark.sql import functions as F

from rideflow.functions import columns as C
from rideflow.functions.udfs import ceil_int, ceil_udf, cos_float, cos_udf
from rideflow.operators import filters, projections, sampling


def test_clamp_scale_flag(spark):
    df = spark.createDataFrame([(-3.0, 1, 2, "N"), (4.0, 1, 1, "Y"), (12.0, None, 1, None), (None, 1, 2, "N")],
                               "fare double, pu int, do int, flag string")
    got = df.select(
        C.clamp("fare", 0, 10).alias("c"),
        C.scale_if(F.col("pu") != F.col("do"), "fare", 0.5).alias("s"),
        C.flag_is("flag", "N").alias("f"),
    ).collect()
    assert [r.c for r in got] == [0.0, 4.0, 10.0, None]
    assert [r.s for r in got] == [-1.5, 4.0, 12.0, None]
    assert [r.f for r in got] == [1, 0, 0, 1]


def test_udfs_match_native_and_pass_nulls(spark):
    df = spark.createDataFrame([(0.2,), (1.0,), (None,), (-1.5,)], "x double")
    got = df.select(ceil_udf("x").alias("u"), ceil_int("x").alias("n"),
                    cos_udf("x").alias("cu"), cos_float("x").alias("cn")).collect()
    assert [r.u for r in got] == [r.n for r in got] == [1, 1, None, -1]
    assert [r.cu for r in got] == [r.cn for r in got]


def test_time_filters(spark):
    df = spark.sql(
        "SELECT CAST(s AS TIMESTAMP) AS pu, CAST(e AS TIMESTAMP) AS do FROM VALUES "
        "('2018-03-20 10:00:00', '2018-03-21 01:00:00'), ('2018-03-20 10:00:00', '2018-03-19 01:00:00'), "
        "('2018-05-05 10:00:00', '2018-05-05 11:00:00'), ('2018-03-17 23:00:00', '2018-03-18 00:30:00') AS v(s, e)"
    )
    assert filters.overnight_only(df, "pu", "do").count() == 2
    assert filters.in_month(df, "pu", "201805").count() == 1
    assert filters.on_unix_day(df, "pu", 1521552311).count() == 2  # 2018-03-20 13:25:11 UTC
    weekend = {r.pu.day: r.day_of_week for r in filters.weekend_only(df, "pu").collect()}
    assert weekend == {5: "Saturday", 17: "Saturday"}
    assert C.unix_day(1521552311) == dt.date(2018, 3, 20)
    dd = df.select(C.doubled_unix_date("pu").alias("d")).collect()[0].d
    assert dd == (dt.datetime(1970, 1, 1) + 2 * (dt.datetime(2018, 3, 20, 10) - dt.datetime(1970, 1, 1))).date()


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "x")], "id int, fare_amount double, extra double, tag string")
    scaled = projections.scale_columns(df, ["fare_amount", "extra"])
    assert scaled.columns == ["id", "fare_amount * 11", "extra * 5", "fare_amount", "extra", "tag"]
    assert scaled.collect()[0]["fare_amount * 11"] == 22.0
    ts = spark.sql("SELECT TIMESTAMP'1967-04-27 10:00:00' AS pickup_datetime")
    assert projections.format_dates(ts).collect()[0].pickup_date == "April 27, 1967"


def test_hash_sample_is_reproducible(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r.k for r in sampling.hash_sample(df, "k", 0.1).collect()}
    b = {r.k for r in sampling.hash_sample(df.repartition(7), "k", 0.1).collect()}
    assert a == b and 120 < len(a) < 280
    assert sampling.md5_threshold(0.0) == "0" * 32
    assert sampling.hash_sample(df, "k", 1.0).count() == 2000


def test_disjoint_batches(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    batches = sampling.disjoint_batches(df, "k", n_batches=10, buckets=1000)
    rows = batches.collect()
    assert {r.batch for r in rows} <= set(range(10))
    assert len({r.k for r in rows}) == len(rows)
    assert 100 < len(rows) < 300
    assert batches.filter(F.col("batch") == 3).count() == sum(1 for r in rows if r.batch == 3)


def test_random_split_covers_all_rows(spark):
    df = spark.range(1000)
    training, test = sampling.random_split(df, 0.2, 42)
    assert training.count() + test.count() == 1000
    assert training.join(test, "id").count() == 0


def test_null_keys_are_values_like_any_other(spark):
    rows = [(i, None if i % 2 else i) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, k int")
    for fraction in (0.5, 0.9999, 1.0):
        nulls = sampling.hash_sample(df, "k", fraction).filter("k IS NULL").count()
        assert nulls in (0, 500)  # rows of one key stay together
    assert sampling.hash_sample(df, "k", 0.9999).count() == 1000
    assert sampling.row_sample(df, 0.5).filter("k IS NULL").count() not in (0, 500)
    batches = sampling.disjoint_batches(df, "k", n_batches=7, buckets=7)
    assert batches.count() == 1000


def test_keys_of_several_columns_are_told_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), ("", None), (None, "")], "x string, y string")
    texts = [r[0] for r in df.select(sampling._key_text(["x", "y"])).collect()]
    assert len(set(texts)) == 6


def test_splits_cover_all_rows_once(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7) for i in range(1000)], "id int, k int")
    for keys in (None, "id", ["k", "id"]):
        training, test = sampling.hash_split(df, 0.2, keys)
        assert training.count() + test.count() == 1000 and training.join(test, "id").count() == 0
        other = sampling.hash_split(df.repartition(5), 0.2, keys)[1]
        assert sorted(r.id for r in other.collect()) == sorted(r.id for r in test.collect())
    training, test = sampling.rand_split(df, 0.2, 42)
    assert training.filter("rand <= 0.2").isEmpty() and test.filter("rand > 0.2").isEmpty()
    assert 100 < sampling.seeded_sample(df, 0.2, 1).count() < 320


def test_name_contains_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("axb",), ("A_B",), ("100%",), (None,)], "s string")
    assert [r.s for r in df.filter(C.name_contains("s", "a_b")).collect()] == ["A_B"]
    assert [r.s for r in df.filter(C.name_contains("s", "%")).collect()] == ["100%"]


def test_percent_text_with_zero_total(spark):
    df = spark.createDataFrame([(3, 0), (1, 4)], "part long, whole long")
    got = [r.p for r in df.select(C.percent_text("part", "whole", "%.1f%%").alias("p")).collect()]
    assert got == [None, "25.0%"]


def test_feature_flag_encodings(spark):
    df = spark.sql(
        "SELECT TIMESTAMP'2018-02-04 18:00:00' AS ts, f AS flag FROM VALUES ('N'), ('Y'), (NULL) AS v(f)"
    )
    module = [r.flag_is_N for r in projections.add_features(df, "ts", "flag", "N").collect()]
    assert module == [1, 0, 0]
    proto = projections.add_features(df, "ts", "flag", "N", flag_out="flag", encoding=(0, 1))
    assert [r.flag for r in proto.collect()] == [0, 1, 1]
    row = proto.collect()[0]
    assert (row.month, row.day_of_week, row.day_of_month) == (2, 1, 4)  # a Sunday
