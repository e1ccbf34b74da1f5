from pyspark.sql import functions as F

from rideflow.operators import aggregates as agg
from rideflow.operators import charts


def _boroughs(spark):
    # The shipped zone file's borough counts: Queens and Manhattan tie at 69.
    counts = {"Queens": 69, "Manhattan": 69, "Brooklyn": 61, "Bronx": 43, "Staten Island": 20, "EWR": 1}
    rows = [(b,) for b, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "borough string")


def test_top_values_ties_broken_by_value(spark):
    got = [(r.borough, r["count"]) for r in agg.top_values(_boroughs(spark), "borough", 3).collect()]
    assert got == [("Manhattan", 69), ("Queens", 69), ("Brooklyn", 61)]


def test_value_shares(spark):
    got = agg.value_shares(_boroughs(spark), "borough", "%2.2f%%").collect()
    assert [r.borough for r in got][:2] == ["Manhattan", "Queens"]
    assert got[0].percentage == "26.24%"
    assert abs(sum(r.share for r in got) - 100.0) < 1e-9
    one = agg.value_shares(_boroughs(spark), "borough", "%.1f%%").collect()
    assert one[-1].percentage == "0.4%"


def test_value_shares_empty_table(spark):
    empty = spark.createDataFrame([], "borough string")
    assert agg.value_shares(empty, "borough").collect() == []


def test_dedup_first_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "q")], "k string, t int, p string"
    )
    got = sorted(tuple(r) for r in agg.dedup_first(df, "k", ["t"]).collect())
    assert got == [("a", 1, "y"), ("b", 5, "q")]
    assert agg.duplicate_keys(agg.dedup_first(df, "k", ["t"]), "k").count() == 0
    assert agg.duplicate_keys(df, "k").collect()[0]["count"] == 3


def test_dedup_report_and_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, s string")
    r = agg.dedup_report(df).collect()[0]
    assert (r.n_before, r.n_after) == (3, 2)
    assert agg.dedup_all(df).count() == 2
    empty = agg.dedup_report(df.limit(0)).collect()[0]
    assert (empty.n_before, empty.n_after) == (0, 0)


def test_collect_values_multiset(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    got = {r.k: [(x.value, x.n) for x in r["values"]] for r in agg.collect_values(df, "k", "v").collect()}
    assert got == {"a": [(1.0, 1), (2.0, 2)], "b": [(None, 1)]}


def test_max_where_and_group_stats(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 7.0), (2, 1.0)], "p int, fare double")
    assert agg.max_where(df, "fare", F.col("p") == 1).collect()[0][0] == 7.0
    stats = {r.p: (r.n_rows, r.max_fare) for r in agg.group_stats(df, "p", "fare").collect()}
    assert stats == {1: (2, 7.0), 2: (1, 1.0)}


def test_bar_chart_data(spark):
    rows = charts.bar_chart_data(_boroughs(spark), "borough", cutoff=25, highlight="Bronx").collect()
    assert [r.category for r in rows] == ["Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island", "EWR"]
    top = rows[0]
    assert (top.category, top.label, top.above_cutoff, top.highlight) == ("Manhattan", "26%", True, False)
    assert [r.category for r in rows if r.highlight] == ["Bronx"]
