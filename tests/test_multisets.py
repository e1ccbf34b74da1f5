"""Multisets of rows, lattices of groups and samples of exact size."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rideflow.operators import multisets as ms
from rideflow.operators import sampling

DDL = "a int, b string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


def test_operations_with_copies_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(ms, "_COPIES", 7)
    left = [(1, "x")] * 40 + [(None, None)] * 3 + [(2, None)] * 2 + [(5, "only")]
    right = [(1, "x")] * 11 + [(None, None)] * 5 + [(2, None)] + [(6, "other")] * 2
    l, r = _frame(spark, left), _frame(spark, right).select("b", "a")
    cl, cr = Counter(left), Counter(right)
    assert Counter(tuple(x) for x in ms.except_all(l, r).collect()) == cl - cr
    assert Counter(tuple(x) for x in ms.intersect_all(l, r).collect()) == cl & cr
    assert Counter(tuple(x) for x in ms.except_all(l, r).collect()) == Counter(tuple(x) for x in l.exceptAll(r.select("a", "b")).collect())
    assert ms.except_all(l.limit(0), r).collect() == [] and ms.intersect_all(l, r.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ms.except_all(l, r.select("a"))


def test_changes_by_key(spark):
    before = _frame(spark, [(1, "x"), (2, "x"), (3, "x"), (3, "x"), (None, "n"), (5, "same")])
    after = _frame(spark, [(1, "y"), (3, "x"), (4, "z"), (None, "m"), (None, "n"), (5, "same")])
    got = {r.a: (r.change, r.n_removed, r.n_added) for r in ms.table_changes(before, after, "a").collect()}
    assert got == {1: ("changed", 1, 1), 2: ("removed", 1, 0), 3: ("removed", 1, 0), 4: ("added", 0, 1), None: ("added", 0, 1)}


def test_lattice_equals_cube_of_the_rows(spark):
    rows = [(i % 3 if i % 7 else None, "pq"[i % 2], i % 11 if i % 5 else None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "d1 int, d2 string, v int, x long").repartition(4)
    got = ms.grouping_lattice(df, ["d1", "d2"], {"x": "x"}, "v")
    want = df.cube("d1", "d2").agg(F.grouping_id().cast("int").alias("grouping"), F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"), F.countDistinct("v").alias("n_distinct"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert got.filter("d1 IS NULL AND grouping = 0").count() == 2


def test_samples_have_exactly_k_rows(spark):
    df = spark.range(2000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 40) END AS s", "id % 10 AS w")
    found = sampling.stratified_sample(df, "s", 12, "id")
    sizes = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert {r.s: r["count"] for r in found.groupBy("s").count().collect()} == {s: min(n, 12) for s, n in sizes.items()}
    again = sampling.stratified_sample(df.repartition(7), "s", 12, "id")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in again.collect()}
    heavy = sampling.stratified_sample(df, [], 300, "id", "w")
    assert heavy.filter("w = 0").isEmpty() and heavy.count() == 300
    share = {r.w: r["count"] for r in heavy.groupBy("w").count().collect()}
    assert share[9] > 2 * share.get(1, 0)
