"""Randomised checks of operators against plain-Python brute force."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rideflow.operators import aggregates as agg
from rideflow.operators import joins, sampling, windows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 4))
rows = st.lists(st.tuples(keys, st.integers(-3, 3), st.sampled_from(["a", "b", "c"])), max_size=40)


@SETTINGS
@given(rows)
def test_dedup_first_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, t int, p string")
    def order(r):
        return (r[0] is not None, r[0] or 0, r[1], r[2])

    got = sorted((tuple(r) for r in agg.dedup_first(df, "k", ["t"]).collect()), key=order)
    best = {}
    for k, t, p in data:
        if k not in best or (t, p) < best[k][1:]:
            best[k] = (k, t, p)
    assert got == sorted(best.values(), key=order)
    assert len(got) == len({k for k, _, _ in data})


@SETTINGS
@given(st.lists(st.tuples(keys, keys), max_size=40))
def test_chain_pair_count_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "pu int, do int")
    got = joins.chain_pair_count(df, "do", df, "pu").collect()[0].n_pairs
    expected = sum(1 for a in data for b in data if a[1] is not None and a[1] == b[0])
    assert got == expected


@SETTINGS
@given(rows)
def test_value_shares_counts(spark, data):
    df = spark.createDataFrame(data, "k int, t int, p string")
    got = agg.value_shares(df, "p").collect()
    assert {r.p: r["count"] for r in got} == dict(Counter(p for _, _, p in data))
    if data:
        assert abs(sum(r.share for r in got) - 100.0) < 1e-9


@SETTINGS
@given(rows, st.integers(1, 3))
def test_latest_n_matches_brute_force(spark, data, n):
    indexed = [(k, t, p, i) for i, (k, t, p) in enumerate(data)]
    df = spark.createDataFrame(indexed, "k int, t int, p string, i int")
    got = sorted((r.k is not None, r.k or 0, r.i) for r in windows.latest_n(df, "k", [F.desc("t"), F.asc("i")], n).collect())
    groups = {}
    for k, t, p, i in indexed:
        groups.setdefault(k, []).append((-t, i))
    expected = sorted((k is not None, k or 0, i) for k, g in groups.items() for _, i in sorted(g)[:n])
    assert got == expected


@SETTINGS
@given(st.floats(0.0, 0.5), st.floats(0.5, 1.0))
def test_hash_samples_nest(spark, small, large):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k for r in sampling.hash_sample(df, "k", small).collect()}
    b = {r.k for r in sampling.hash_sample(df, "k", large).collect()}
    assert a <= b
