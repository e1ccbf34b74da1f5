"""The ride preparation chain (R1, R2) over any table with ride-like columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rideflow.functions.columns import name_contains
from rideflow.operators.aggregates import dedup_all
from rideflow.operators.filters import keep_hours, limit_history
from rideflow.operators.joins import exclude_by_dim
from rideflow.operators.projections import add_features
from rideflow.operators.windows import first_n_daily


@dataclass(frozen=True)
class RideColumns:
    """Which columns of a table play the ride roles."""

    pickup_ts: str = "pickup_datetime"
    dropoff_ts: str = "dropoff_datetime"
    locations: Sequence[str] = ("pickup_location_id", "dropoff_location_id")
    flag: str = "store_and_fwd_flag"
    flag_value: str = "N"
    tie_breakers: Sequence[str] = ()


@dataclass(frozen=True)
class ZoneColumns:
    """Which columns of the dimension hold the key and the name tested for exclusion."""

    key: str = "zone_id"
    name: str = "zone_name"
    excluded_word: str = "airport"


@dataclass(frozen=True)
class PrepareConfig:
    """Overridable parameters of the preparation."""

    # The months, hours and number of rides of the trip model.
    after_month: str = "201703"  # exclusive
    through_month: str = "201811"  # inclusive
    first_hour: int = 17
    last_hour: int = 23
    rides_per_day: int = 3
    exclusion_mode: str = "anti"
    ride: RideColumns = field(default_factory=RideColumns)
    zone: ZoneColumns = field(default_factory=ZoneColumns)


def filter_rides(df: DataFrame, zones: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    """Month range, evening hours, zone exclusion, distinct rows, first n per zone and day.

    Filters and the exclusion are per-row and deterministic, so they commute
    with the full-row distinct; Catalyst pushes them below it anyway, and the
    distinct then only shuffles the surviving rows.
    """
    r, z = cfg.ride, cfg.zone
    out = dedup_all(df)
    out = limit_history(out, r.pickup_ts, cfg.after_month, cfg.through_month)
    out = keep_hours(out, r.dropoff_ts, cfg.first_hour, cfg.last_hour)
    excluded = name_contains(z.name, z.excluded_word)
    for loc in r.locations:
        out = exclude_by_dim(out, loc, zones, z.key, excluded, mode=cfg.exclusion_mode)
    return first_n_daily(
        out,
        r.locations[0],
        r.pickup_ts,
        cfg.rides_per_day,
        tie_breakers=r.tie_breakers,
    )


def prepare_rides(df: DataFrame, zones: DataFrame, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    """``filter_rides`` followed by the feature columns (R1 + R2)."""
    r = cfg.ride
    return filter_rides(df, zones, cfg).transform(
        add_features, r.pickup_ts, r.flag, r.flag_value
    )
