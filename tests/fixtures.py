"""Small in-memory tables: one full base row per table, and what each row changes of it."""

from __future__ import annotations

import datetime as dt

from rideflow.sources.tables import TRIP_SCHEMA, ZONE_SCHEMA

UTC = dt.timezone.utc
_EVENING = dt.datetime(2018, 9, 20, 20, 15, tzinfo=UTC)


def _base(schema):
    """A value for every column, by its type and place."""
    by_type = {
        "timestamp": lambda i: _EVENING + dt.timedelta(minutes=i),
        "string": lambda i: f"text {i}",
        "int": lambda i: i + 1,
        "bigint": lambda i: i + 1,
        "double": lambda i: i + 0.25,
    }
    return {f.name: by_type[f.dataType.simpleString()](i) for i, f in enumerate(schema)}


def _frame(spark, schema, changes):
    base = _base(schema)
    unknown = {name for change in changes for name in change} - set(base)
    if unknown:
        raise KeyError(f"no such columns: {sorted(unknown)}")
    return spark.createDataFrame([tuple((base | change).values()) for change in changes], schema)


def trips(spark, *changes):
    """A trip per dict of changed columns; without any, the base trip."""
    return _frame(spark, TRIP_SCHEMA, changes or ({},))


def zones(spark, *changes):
    return _frame(spark, ZONE_SCHEMA, changes or ({},))


def at(year, month, day, hour=20, minute=0, second=0):
    return dt.datetime(year, month, day, hour, minute, second, tzinfo=UTC)
