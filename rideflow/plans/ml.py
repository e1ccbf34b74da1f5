"""Spark ML steps (2.14): assemble, train, score, importances, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The learners' settings.
RF_PARAMS = {"numTrees": 10, "maxDepth": 4, "featureSubsetStrategy": "auto", "seed": 42, "bootstrap": True}
GBT_PARAMS = {"stepSize": 0.1, "maxDepth": 4, "featureSubsetStrategy": "auto", "seed": 42}


def assemble(feature_cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """Feature vector from the named columns (K1); ``handle_invalid`` may be ``skip`` or ``keep``."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid=handle_invalid)


def make_learner(kind: str, label: str, features: str = "features", prediction: str = "prediction", **overrides):
    """Random forest (K2) or gradient-boosted trees (K3) regressor."""
    if kind == "rf":
        params = {**RF_PARAMS, **overrides}
        return RandomForestRegressor(labelCol=label, featuresCol=features, predictionCol=prediction, **params)
    if kind == "gbt":
        params = {**GBT_PARAMS, **overrides}
        return GBTRegressor(labelCol=label, featuresCol=features, predictionCol=prediction, **params)
    raise ValueError(f"unknown learner {kind!r}")


def train(
    df: DataFrame,
    feature_cols: Sequence[str],
    label: str,
    learner: str = "rf",
    handle_invalid: str = "error",
    **overrides,
) -> PipelineModel:
    """Fit assembler + learner as one pipeline (K4)."""
    pipeline = Pipeline(stages=[assemble(feature_cols, handle_invalid=handle_invalid), make_learner(learner, label, **overrides)])
    return pipeline.fit(df)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring (K5)."""
    return model.transform(df)


def feature_importances(model: PipelineModel, feature_cols: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) sorted by importance, then name (K6).

    The importances are a model attribute of one value per feature, so this
    table has as many rows as there are features.
    """
    values = model.stages[-1].featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    rows = list(zip(feature_cols, [float(v) for v in values], strict=True))
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), F.asc("feature"))


def regression_metrics(
    predictions: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """rmse, mae, r2 and the row count in one aggregate pass (K7), optionally per group.

    ``r2 = 1 - SSE / SST`` as Spark's evaluator defines it, with
    ``SST = n * var_pop(y)``: the variance aggregate merges partial moments, so
    it stays accurate over billions of rows where ``sum(y^2) - sum(y)^2 / n``
    would cancel.  A constant label gives null.
    """
    y = F.col(label).cast("double")
    err = y - F.col(prediction).cast("double")
    grouped = predictions.groupBy(*by) if by else predictions
    agg = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("sse"),
        F.sum(F.abs(err)).alias("sae"),
        F.var_pop(y).alias("var_y"),
    )
    sst = F.col("var_y") * F.col("n")
    return agg.select(
        *by,
        F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("rmse"),
        F.try_divide(F.col("sae"), F.col("n")).alias("mae"),
        F.when(sst > 0, F.lit(1.0) - F.col("sse") / sst).alias("r2"),
        F.col("n").alias("n_rows"),
    )
