"""Structured Streaming form of the ride filters.

The reference has no stream.  What carries over unchanged are the stateless
steps: the month range, the hour range and the exclusion against a static
dimension (a stream-static left anti join).  Deduplication and the first-n
window need state and are not offered on streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rideflow.functions.columns import name_contains
from rideflow.operators.filters import keep_hours, limit_history
from rideflow.operators.joins import exclude_by_dim
from rideflow.operators.rides import PrepareConfig
from rideflow.session import scratch_path


def filter_ride_stream(stream: DataFrame, zones: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """Month range, evening hours and zone exclusion on a streaming DataFrame."""
    r, z = cfg.ride, cfg.zone
    out = limit_history(stream, r.pickup_ts, cfg.after_month, cfg.through_month)
    out = keep_hours(out, r.dropoff_ts, cfg.first_hour, cfg.last_hour)
    for loc in r.locations:
        out = exclude_by_dim(out, loc, zones, z.key, name_contains(z.name, z.excluded_word))
    return out


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """The Parquet files of a folder or glob as a stream; ``max_files`` bounds each micro-batch, so
    catching up on a large backlog runs as several bounded batches rather than one."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_filtered(stream: DataFrame, zones: DataFrame, cfg: PrepareConfig, sink_root: str | None = None) -> DataFrame:
    """Run the filters over ``stream`` until caught up, then read the sink.

    The sink and its checkpoint live below ``spark.checkpoint.dir``, so a
    restarted query resumes where it stopped and writes each batch once.  Pass
    the same ``sink_root`` again to resume a stopped or failed run: files
    already processed are skipped and no row is written twice.
    """
    kept = filter_ride_stream(stream, zones, cfg)
    root = sink_root or scratch_path(stream.sparkSession, "stream")
    running = (
        kept.writeStream.format("parquet")
        .option("path", f"{root}/data")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return stream.sparkSession.read.schema(kept.schema).parquet(f"{root}/data")
