"""Table and model sinks (S6, S7, S9) and the saved-and-reread intermediate."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rideflow.session import _context, scratch_path


def save_table(
    df: DataFrame,
    path: str | None = None,
    *,
    name: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> None:
    """Write ``df`` to a path or as a catalog table.

    ``overwriteSchema`` is a table-format option that Parquet ignores; an
    overwrite replaces the files and therefore the schema anyway.
    """
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name is not None:
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    elif path is not None:
        writer.save(path)
    else:
        raise ValueError("give a path or a table name")


#: Shuffle files go when the job that wrote them has ended, not when the driver's JVM collects garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def materialize(
    df: DataFrame,
    spark: SparkSession | None = None,
    *,
    label: str = "intermediate",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: later jobs (training, every evaluation) read the
    files instead of re-running scans, joins and windows, and a lost executor
    only costs re-reading files from the shared folder.  The shuffles behind
    the files are of no more use and give their disk back at once.
    """
    spark = spark or df.sparkSession
    path = scratch_path(spark, label)
    with _shuffles_dropped(spark):
        save_table(df, path, partition_by=partition_by)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def free_scratch(spark: SparkSession, paths: Iterable[str], frame: DataFrame) -> list[str]:
    """Delete those scratch locations whose files ``frame`` does not read; the others come back.

    Only Spark's own scans are seen: a frame whose Python functions open scratch files when it runs
    must be written first.
    """
    names = {name for f in frame.inputFiles() for name in f.split("/")}
    kept = [p for p in paths if p.rsplit("/", 1)[1] in names]
    sc = _context(spark)
    if sc is None:  # Spark Connect has no file system to ask
        return list(paths)
    for p in set(paths) - set(kept):
        at = sc._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
    return kept


def save_model(model, path: str) -> str:
    """Persist a fitted ``PipelineModel``."""
    model.write().overwrite().save(path)
    return path
