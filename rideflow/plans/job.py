"""The batch job: extract, transform, train, validate, load."""

from __future__ import annotations

import dataclasses
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.operators.rides import PrepareConfig, prepare_rides
from rideflow.operators.sampling import hash_split
from rideflow.plans import ml
from rideflow.session import build_session
from rideflow.sources.sinks import materialize, save_model
from rideflow.sources.tables import TRIP_SCHEMA, ZONE_SCHEMA, TableSpec, extract

log = logging.getLogger(__name__)

# The trip model's feature columns.
TRIP_FEATURES = (
    "passenger_count",
    "trip_distance",
    "rate_code",
    "payment_type",
    "fare_amount",
    "tolls_amount",
    "imp_surcharge",
    "month",
    "day_of_week",
    "day_of_month",
    "store_and_fwd_flag_is_N",
)


@dataclass(frozen=True)
class RideConfig:
    """Everything a run can override (R6); replace fields with ``dataclasses.replace``."""

    prepare: PrepareConfig = field(default_factory=PrepareConfig)
    test_fraction: float = 0.2
    split_keys: Sequence[str] | None = None  # columns whose hash splits; None: the whole row
    learner: str = "rf"
    label: str = "tip_amount"
    feature_cols: Sequence[str] = TRIP_FEATURES
    handle_invalid: str = "error"
    trips_name: str = "taxi_trip_data"
    zones_name: str = "taxi_zone_geo"
    materialize_prepared: bool = True


class RideJob:
    """One run of the job; every stage is a separate method so it can be re-run.

    ``tables`` holds the named DataFrames and is the injection point for tests:
    fill it and call ``transform`` without ``extract``.
    """

    def __init__(self, config: RideConfig, spark: SparkSession, sources: dict[str, TableSpec] | None = None):
        self.config = config
        self.spark = spark
        self.sources = sources or {}
        self.tables: dict[str, DataFrame] = {}
        self.model = None
        self.report: dict[str, DataFrame] = {}

    def run(self, model_path: str | None = None) -> dict[str, DataFrame]:
        self.extract()
        self.transform()
        self.train()
        self.validate()
        if model_path:
            self.load(model_path)
        return self.report

    def extract(self) -> None:
        """Read every configured source (S3)."""
        self.tables.update(extract(self.spark, self.sources))

    def transform(self) -> None:
        cfg = self.config
        prepared = prepare_rides(self.tables[cfg.trips_name], self.tables[cfg.zones_name], cfg.prepare)
        self.tables["prepared_data"] = prepared
        self.tables.pop("prepared_files", None)

    def train(self, learner: str | None = None) -> None:
        """Split and fit; ``learner`` swaps the regressor for this call."""
        cfg = self.config
        prepared = self.tables["prepared_data"]
        if cfg.materialize_prepared:
            # Written once per transform: the fit and every evaluation read
            # files instead of re-running scans, the anti joins and the window,
            # and a re-run with another learner or split reuses them.
            if "prepared_files" not in self.tables:
                self.tables["prepared_files"] = materialize(prepared, self.spark, label="prepared")
            prepared = self.tables["prepared_files"]
        self.tables["training"], self.tables["test"] = hash_split(prepared, cfg.test_fraction, cfg.split_keys)
        self.model = ml.train(
            self.tables["training"],
            cfg.feature_cols,
            cfg.label,
            learner or cfg.learner,
            handle_invalid=cfg.handle_invalid,
        )

    def parts(self) -> DataFrame:
        """All prepared rows with the part (``set``) they are in."""
        return self.tables["training"].withColumn("set", F.lit("training")).unionByName(
            self.tables["test"].withColumn("set", F.lit("test"))
        )

    def validate(self) -> None:
        cfg = self.config
        self.report["importances"] = ml.feature_importances(self.model, cfg.feature_cols, self.spark)
        # Both sets scored and measured in one pass, grouped by set.
        self.report["metrics"] = ml.regression_metrics(ml.score(self.model, self.parts()), cfg.label, by=["set"])
        log.info("validation reports ready: %s", ", ".join(self.report))

    def load(self, path: str) -> str:
        """Save the fitted pipeline."""
        return save_model(self.model, path)

    def with_config(self, **changes) -> RideJob:
        """A job sharing the loaded data with some parameters replaced."""
        job = RideJob(dataclasses.replace(self.config, **changes), self.spark, self.sources)
        job.tables = dict(self.tables)
        job.model = self.model
        return job


def main(argv: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Run the job from the command line: ``python -m rideflow.plans.job --trips ... --zones ...``."""
    import argparse

    parser = argparse.ArgumentParser(prog="rideflow-job", description=__doc__)
    parser.add_argument("--trips", required=True, help="trip table (folder or file)")
    parser.add_argument("--zones", required=True, help="zone table (folder or file)")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--model", help="where to save the fitted pipeline")
    parser.add_argument("--learner", default="rf", choices=["rf", "gbt"])
    parser.add_argument("--test-fraction", type=float, default=0.2)
    parser.add_argument("--history", nargs=2, default=["201703", "201811"], metavar=("AFTER", "THROUGH"))
    args = parser.parse_args(argv)

    spark = build_session()
    sources = {
        "taxi_trip_data": TableSpec(args.trips, args.format, TRIP_SCHEMA),
        "taxi_zone_geo": TableSpec(args.zones, args.format, ZONE_SCHEMA),
    }
    prepare = dataclasses.replace(
        PrepareConfig(), after_month=args.history[0], through_month=args.history[1]
    )
    job = RideJob(
        RideConfig(prepare=prepare, learner=args.learner, test_fraction=args.test_fraction), spark, sources
    )
    report = job.run(model_path=args.model)
    for name, df in report.items():
        print(name)
        df.show(truncate=False)
    return report


if __name__ == "__main__":
    main()
