import dataclasses
import datetime as dt
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator

from rideflow.plans import ml
from rideflow.plans.job import RideConfig, RideJob
from rideflow.session import scratch_path
from tests.fixtures import UTC, trips, zones


def _rides(spark, n=300):
    rnd = random.Random(3)
    changes = []
    for i in range(n):
        start = dt.datetime(2018, 1, 1, 17, tzinfo=UTC) + dt.timedelta(days=rnd.randint(0, 300), minutes=rnd.randint(0, 200))
        fare = rnd.uniform(3, 60)
        changes.append({
            "pickup_datetime": start, "dropoff_datetime": start + dt.timedelta(minutes=30),
            "passenger_count": rnd.randint(1, 5), "trip_distance": rnd.uniform(0.5, 20), "fare_amount": fare,
            "tip_amount": 0.15 * fare + rnd.uniform(-0.5, 0.5), "pickup_location_id": i,
            "store_and_fwd_flag": rnd.choice(["Y", "N"]),
        })
    return trips(spark, *changes)


def test_regression_metrics_match_evaluator(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.uniform(0, 10), rnd.uniform(0, 10)) for _ in range(200)], "y double, prediction double")
    got = ml.regression_metrics(df, "y").collect()[0]
    ev = RegressionEvaluator(labelCol="y", predictionCol="prediction")
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(ev.evaluate(df, {ev.metricName: name}), rel=1e-9)
    assert got.n_rows == 200


def test_regression_metrics_constant_label(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, prediction double")
    got = ml.regression_metrics(df, "y").collect()[0]
    assert got.r2 is None and got.mae == 0.5


@pytest.mark.parametrize("learner", ["rf", "gbt"])
def test_job_runs_end_to_end(spark, learner):
    job = RideJob(RideConfig(learner=learner), spark)
    job.tables["taxi_trip_data"] = _rides(spark)
    job.tables["taxi_zone_geo"] = zones(spark)
    job.transform()
    job.train()
    job.validate()
    metrics = {r.set: r for r in job.report["metrics"].collect()}
    assert set(metrics) == {"training", "test"}
    assert metrics["training"].n_rows + metrics["test"].n_rows == job.tables["prepared_data"].count()
    imps = job.report["importances"].collect()
    assert len(imps) == 11 and abs(sum(r.importance for r in imps) - 1.0) < 1e-6
    assert [r.importance for r in imps] == sorted((r.importance for r in imps), reverse=True)
    path = job.load(scratch_path(spark, "model-test"))
    again = ml.score(PipelineModel.load(path), job.tables["test"]).select("prediction").collect()
    before = ml.score(job.model, job.tables["test"]).select("prediction").collect()
    assert again == before


def test_partial_rerun_with_new_config(spark):
    job = RideJob(RideConfig(), spark)
    job.tables["taxi_trip_data"] = _rides(spark)
    job.tables["taxi_zone_geo"] = zones(spark)
    job.transform()
    smaller = job.with_config(test_fraction=0.01)
    assert dataclasses.asdict(smaller.config)["test_fraction"] == 0.01
    smaller.train(learner="gbt")
    assert smaller.model.stages[-1].__class__.__name__ == "GBTRegressionModel"


def test_null_feature_policy(spark):
    from pyspark.sql import functions as F

    raw = _rides(spark, 120).withColumn(
        "fare_amount", F.when(F.col("pickup_location_id") % 2 == 0, F.lit(None)).otherwise(F.col("fare_amount"))
    )
    strict = RideJob(RideConfig(), spark)
    strict.tables["taxi_trip_data"] = raw
    strict.tables["taxi_zone_geo"] = zones(spark)
    strict.transform()
    with pytest.raises(Exception):
        strict.train()  # VectorAssembler rejects null features by default
    lenient = strict.with_config(handle_invalid="skip")
    lenient.train()
    lenient.validate()
    n_scored = sum(r.n_rows for r in lenient.report["metrics"].collect())
    assert 0 < n_scored < lenient.tables["prepared_data"].count()


def test_run_from_csv_sources(spark, tmp_path):
    from rideflow.sources import TRIP_SCHEMA, ZONE_SCHEMA, TableSpec

    trips_dir = str(tmp_path / "trips")
    _rides(spark, 200).write.option("header", "true").csv(trips_dir)
    zones_csv = tmp_path / "zones.csv"
    zones_csv.write_text("zone_id,zone_name,borough\n1,Newark Airport,EWR\n2,Jamaica Bay,Queens\n")
    sources = {
        "taxi_trip_data": TableSpec(trips_dir, "csv", TRIP_SCHEMA),
        "taxi_zone_geo": TableSpec(str(zones_csv), "csv", ZONE_SCHEMA),
    }
    job = RideJob(RideConfig(), spark, sources)
    report = job.run(model_path=scratch_path(spark, "model-csv"))
    assert job.tables["prepared_data"].filter("pickup_location_id = 1").count() == 0  # an airport
    assert {r.set for r in report["metrics"].collect()} == {"training", "test"}


def test_retrain_reuses_materialized_data(spark):
    job = RideJob(RideConfig(), spark)
    job.tables["taxi_trip_data"] = _rides(spark, 120)
    job.tables["taxi_zone_geo"] = zones(spark)
    job.transform()
    job.train()
    files = job.tables["prepared_files"].inputFiles()
    again = job.with_config(test_fraction=0.3)
    again.train(learner="gbt")
    assert again.tables["prepared_files"].inputFiles() == files
    job.transform()
    assert "prepared_files" not in job.tables


def test_command_line_entry(spark, tmp_path, capsys):
    from rideflow.plans.job import main

    trips_dir = str(tmp_path / "trips")
    _rides(spark, 150).write.parquet(trips_dir)
    zone_dir = str(tmp_path / "zones")
    zones(spark, {"zone_id": 3, "zone_name": "LaGuardia Airport"}).write.parquet(zone_dir)
    report = main(["--trips", trips_dir, "--zones", zone_dir, "--format", "parquet", "--learner", "gbt",
                   "--model", str(tmp_path / "model")])
    assert report["metrics"].count() == 2
    assert "importances" in capsys.readouterr().out
