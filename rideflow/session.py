"""Session set-up (S0) and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  The time zone is pinned so that
# hour, day and month boundaries do not move with the host's zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "rideflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or attach to) a session with UTC, AQE and the UI switched off.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass
    ``local[*]``.  Extra ``conf`` wins over the defaults.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate may return a session that already existed: re-apply the
    # runtime settings that matter for results.
    spark.conf.set("spark.sql.session.timeZone", settings["spark.sql.session.timeZone"])
    spark.conf.set("spark.sql.adaptive.enabled", settings["spark.sql.adaptive.enabled"])
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises for sparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is used as is.  Only when nothing is configured and
    the master is ``local[...]`` (a test run) a fresh temporary folder is
    created and registered; on a cluster a missing setting is an error.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder every executor can read "
                "(HDFS, S3, ...); a machine-local folder would not survive a lost executor"
            )
        configured = tempfile.mkdtemp(prefix="rideflow-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


_made: ContextVar[list[str] | None] = ContextVar("scratch_made", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location below the checkpoint folder."""
    path = f"{checkpoint_root(spark)}/rideflow/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """The locations that :func:`scratch_path` gives out inside; those of a block within count for both."""
    made, outer = [], _made.get()
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        if outer is not None:
            outer += made
