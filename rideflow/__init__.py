"""rideflow: parameterised PySpark operators for ride-like and event-like tables."""

import sys

from rideflow.session import build_session, checkpoint_root

# The few Python functions that run inside tasks (Arrow batch helpers, pandas
# UDFs) are shipped with the job by value, so executors need no install of
# this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package with --py-files
    pass

__all__ = ["build_session", "checkpoint_root"]
