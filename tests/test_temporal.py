"""As-of and interval joins, sliding frames, sessions and quantiles against plain Python and plain Spark."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rideflow.operators import quantiles, temporal


def _rows(seed, n, keys=("hot",) * 6 + ("a", "b", None)):
    rnd = random.Random(seed)
    return [(i, rnd.choice(keys), None if rnd.random() < 0.03 else rnd.randint(0, 3 * n), rnd.randint(-5, 50)) for i in range(n)]


@pytest.mark.parametrize("buckets, tolerance", [(None, None), (9, 40)])
def test_as_of_join(spark, buckets, tolerance):
    left, right = _rows(1, 400), _rows(2, 300)
    right += [(1000 + i, "hot", 500, i) for i in range(5)]  # one time: the largest id counts
    l = spark.createDataFrame(left, "id long, k string, t long, v int").repartition(3)
    r = spark.createDataFrame(right, "id long, rk string, rt long, v int").repartition(3)
    found = temporal.as_of_join(
        l, r, {"k": "rk"}, "t", "rt", {"right_id": "id", "right_t": "rt"}, right_order=["id"], tolerance=tolerance, buckets=buckets
    )
    assert found.columns == ["id", "k", "t", "v", "right_id", "right_t"]
    got = {x.id: (x.right_id, x.right_t) for x in found.collect()}
    want = {}
    for i, k, t, _ in left:
        fits = [(rt, ri) for ri, rk, rt, _ in right if None not in (k, t, rk, rt) and rk == k and rt <= t and (tolerance is None or t - rt <= tolerance)]
        want[i] = max(fits)[::-1] if fits else (None, None)
    assert got == want
    inner = temporal.as_of_join(l, r, {"k": "rk"}, "t", "rt", {"right_id": "id"}, right_order=["id"], tolerance=tolerance, how="inner", buckets=buckets)
    assert {x.id: x.right_id for x in inner.collect()} == {i: r for i, (r, _) in want.items() if r is not None}


def test_as_of_join_of_empty_tables_and_clashes(spark):
    l = spark.createDataFrame(_rows(1, 20), "id long, k string, t long, v int")
    none = temporal.as_of_join(l, l.limit(0), ["k"], "t", "t", {"other": "id"})
    assert none.count() == 20 and none.filter("other IS NOT NULL").isEmpty()
    assert temporal.as_of_join(l.limit(0), l, ["k"], "t", "t", {"other": "id"}).collect() == []
    with pytest.raises(ValueError):
        temporal.as_of_join(l, l, ["k"], "t", "t", {"v": "v"})
    with pytest.raises(ValueError):
        temporal.as_of_join(l, l, ["k"], "k", "t", {"other": "id"})


@pytest.mark.parametrize("width, with_key", [(None, True), (1, False), (1000, True)])
def test_interval_join(spark, width, with_key):
    rnd = random.Random(4)

    def intervals(n, longest):
        rows = []
        for i in range(n):
            a = rnd.randint(-400, 400)
            rows.append((i, rnd.choice(["x", "x", "y", None]), a, a + int(longest ** rnd.random()) - 1))
        return rows + [(n, "x", None, 5), (n + 1, "x", 5, None), (n + 2, "x", 9, 3), (n + 3, "x", -10_000, 10_000)]

    left, right = intervals(80, 300), intervals(90, 20)
    l = spark.createDataFrame(left, "i long, k string, a long, b long").repartition(2)
    r = spark.createDataFrame(right, "j long, rk string, c long, d long").repartition(2)
    found = temporal.interval_join(l, r, ("a", "b"), ("c", "d"), {"k": "rk"} if with_key else {}, width=width)
    got = sorted((x.i, x.j) for x in found.collect())
    want = sorted(
        (i, j)
        for i, k, a, b in left
        for j, rk, c, d in right
        if None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b and (not with_key or (k is not None and k == rk))
    )
    assert got == want and len(set(got)) == len(got)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    points = temporal.interval_join(l, r.select("j", "rk", "c"), ("a", "b"), ("c", "c"), {"k": "rk"}, width=width)
    assert sorted((x.i, x.j) for x in points.collect()) == sorted(
        (i, j) for i, k, a, b in left for j, rk, c, _ in right if None not in (a, b, c, k) and k == rk and a <= c <= b
    )


@pytest.mark.parametrize("buckets, preceding", [(None, 25), (11, 0), (11, 25), (11, 5000)])
def test_frames_equal_plain_windows(spark, buckets, preceding):
    df = spark.createDataFrame(_rows(5, 500), "id long, k string, t long, v int").repartition(3).cache()
    got = temporal.frame_aggregates(df, {"s": F.sum("v"), "m": F.max("id"), "n": F.count("v")}, "k", "t", preceding, buckets=buckets)
    assert got.columns == ["id", "k", "t", "v", "s", "m", "n"]
    frame = Window.partitionBy("k").orderBy("t").rangeBetween(-preceding, Window.currentRow)
    timed = df.filter("t IS NOT NULL").withColumns({"s": F.sum("v").over(frame), "m": F.max("id").over(frame), "n": F.count("v").over(frame)})
    want = {tuple(r) for r in timed.collect()} | {(*r, None, None, None) for r in df.filter("t IS NULL").collect()}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == 500


@pytest.mark.parametrize("buckets, gap", [(None, 3), (13, 0), (13, 3), (13, 100_000)])
def test_sessions(spark, buckets, gap):
    rows = _rows(6, 500)
    df = spark.createDataFrame(rows, "id long, k string, t long, v int").repartition(3)
    got = {r.id: r.session for r in temporal.sessions(df, "k", "t", gap, order=["id"], buckets=buckets).collect()}
    want, last = {}, {}
    for i, k, t, _ in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
        if t is None:
            want[i] = None
            continue
        number, before = last.get(k, (0, None))
        number += before is None or t - before > gap
        last[k] = number, t
        want[i] = number
    assert got == want
    lengths = temporal.session_lengths(df, "k", "t", gap, buckets=buckets)
    assert sum(r.n for r in lengths.collect()) == sum(t is not None for _, _, t, _ in rows)
    assert lengths.count() == sum(n for n, _ in last.values())


def test_timestamps_and_empty_tables(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0), (1, t0 + dt.timedelta(hours=2)), (1, t0 + dt.timedelta(hours=2, seconds=1)), (2, None)]
    df = spark.createDataFrame(rows, "k long, t timestamp")
    assert sorted(r.session or 0 for r in temporal.sessions(df, "k", "t", 2 * temporal.HOUR).collect()) == [0, 1, 1, 1]
    assert sorted(r.session or 0 for r in temporal.sessions(df, "k", "t", temporal.HOUR).collect()) == [0, 1, 2, 2]
    for empty in (temporal.sessions(df.limit(0), "k", "t", 1), temporal.frame_aggregates(df.limit(0), {"n": F.count("k")}, "k", "t", 1)):
        assert empty.collect() == []


def _quantile(values, share):
    values = sorted(v for v in values if v is not None and v == v)
    return values[max(math.ceil(Decimal(str(share)) * len(values)), 1) - 1] if values else None


@pytest.mark.parametrize("kind", ["double", "long", "decimal(38,2)", "date", "wide"])
def test_quantiles(spark, kind):
    rnd = random.Random(kind)
    make = {
        "double": lambda: rnd.choice([rnd.gauss(0, 1), float("nan"), rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300), 0.0, 5e-324, -math.inf]),
        "long": lambda: rnd.choice([rnd.randint(-(1 << 63), (1 << 63) - 1), (1 << 62) + rnd.randint(0, 40), rnd.randint(0, 9)]),
        "decimal(38,2)": lambda: Decimal(rnd.randint(-(10**9), 10**9)) / 100,
        "date": lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 4000)),
        "wide": lambda: 10.0 ** rnd.randint(-300, 300),
    }[kind]
    rows = [(rnd.choice(["hot"] * 5 + ["a", None]), None if rnd.random() < 0.1 else make()) for _ in range(700)] + [("empty", None), ("one", make())]
    if kind == "double":
        rows = [(k, v if v is None or math.isfinite(v) or v != v else 1.5) for k, v in rows]
    df = spark.createDataFrame(rows, f"k string, v {'double' if kind == 'wide' else kind}").repartition(3)
    got = {r.k: (r.low, r.q50, r.q99, r.top) for r in quantiles.exact_quantiles(df, "k", "v", {"low": 0, "q50": 0.5, "q99": "0.99", "top": 1}).collect()}
    assert got == {k: tuple(_quantile([v for x, v in rows if x == k], q) for q in (0, 0.5, 0.99, 1)) for k in {k for k, _ in rows}}
    assert quantiles.exact_quantiles(df.limit(0), "k", "v", {"q50": 0.5}).collect() == []


@pytest.mark.parametrize("max_sorted", [0, 30, 10**6])
def test_quantiles_sorted_and_by_passes(spark, max_sorted):
    rnd = random.Random(max_sorted)
    rows = [(rnd.choice(["hot"] * 8 + ["a", None]), None if rnd.random() < 0.1 else rnd.choice([rnd.randint(0, 10**12), rnd.randint(0, 5)])) for _ in range(900)]
    rows += [("empty", None), ("one", 7)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(3)
    found = quantiles.exact_quantiles(df, "k", "v", {"low": 0, "q25": 0.25, "top": 1}, max_sorted=max_sorted)
    got = {r.k: (r.low, r.q25, r.top) for r in found.collect()}
    assert got == {k: tuple(_quantile([v for x, v in rows if x == k], q) for q in (0, 0.25, 1)) for k in {k for k, _ in rows}}


def test_quantiles_of_many_small_groups_take_no_pass(spark, monkeypatch):
    labels = []
    keep = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, *a, label, **k: labels.append(label) or keep(df, *a, label=label, **k))
    df = spark.range(4000).selectExpr("id % 40 AS k", "date_add(DATE'2000-01-01', int(id * 7919 % 5000)) AS v")
    got = {r.k: r.q for r in quantiles.exact_quantiles(df, "k", "v", {"q": 0.25}).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.v)
    assert got == {k: _quantile(v, 0.25) for k, v in values.items()}
    assert labels.count("quantile-state") == 1
