"""The physical plans keep the properties the library is designed around."""

from pathlib import Path

import pytest

from rideflow.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF, "events.parquet").exists(), reason="driver tables not present")


def _plan(spark, name):
    df = catalog.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_pushes_month_range_and_limits_before_shuffle(spark):
    plan = _plan(spark, "prepared_events")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-01T00:00), LessThan(ts,2024-02-01T00:00)]" in plan
    assert "row_number(), 3, Partial" in plan
    assert "LeftAnti" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_top_n_per_group_is_limited_map_side(spark):
    for name, n in [("latest_3", 3), ("dedup_orders", 1), ("first_n_daily", 3)]:
        assert f"row_number(), {n}, Partial" in _plan(spark, name), name


def test_shares_use_no_window_over_all_rows(spark):
    plan = _plan(spark, "segment_shares")
    assert "Window" not in plan
    assert "Subquery" in plan


def test_running_sum_windows_are_per_range(spark):
    plan = _plan(spark, "running_tax")
    assert "windowspecdefinition(l_returnflag" in plan
    assert "hashpartitioning(l_returnflag" in plan and "_bucket" in plan
    # Both sides read the range number from the same files.
    assert plan.count("ranges-") >= 2


def test_pair_count_joins_counts_not_rows(spark):
    plan = _plan(spark, "chain_pair_count")
    join_at = plan.index("Join")
    # both join inputs are aggregates of the key counts
    assert plan.count("HashAggregate") >= 4
    assert "partial_count" in plan[join_at:]


def test_projection_is_pruned(spark):
    plan = _plan(spark, "scatter_series")
    assert "ReadSchema: struct<p_type:string,p_size:int,p_retailprice:double>" in plan


def test_two_exclusions_share_one_broadcast(spark, tmp_path):
    from rideflow.operators.rides import prepare_rides
    from tests.fixtures import trips, zones

    places = [{"pickup_location_id": p, "dropoff_location_id": d} for p, d in ((1, 2), (3, 4))]
    trips(spark, *places).write.parquet(str(tmp_path / "t"))
    zones(spark, {"zone_id": 3, "zone_name": "JFK Airport"}).write.parquet(str(tmp_path / "z"))
    t = spark.read.parquet(str(tmp_path / "t"))
    z = spark.read.parquet(str(tmp_path / "z"))
    df = prepare_rides(t, z)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("LeftAnti") == 2
    assert "ReusedExchange" in plan
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert "GreaterThanOrEqual(pickup_datetime,2017-04-01 00:00:00.0), LessThan(pickup_datetime,2018-12-01" in buf.getvalue()


def test_no_query_uses_pairwise_joins_or_row_udfs(spark):
    # Queries that fit a model or write tables while they are built.
    skip = {"rf_metrics", "gbt_metrics", "importances", "saved_model_scores", "reloaded_scores", "model_metrics",
            "importance_sum", "job_run", "random_split_counts", "stream_filtered_events", "disjoint_batches",
            "saved_and_reread"}
    for name, fn in catalog.queries().items():
        if name in skip:
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (name, bad)
