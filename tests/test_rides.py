import dataclasses
import datetime as dt

import pytest

from rideflow.operators.rides import PrepareConfig, prepare_rides
from rideflow.plans.job import TRIP_FEATURES, RideConfig, RideJob
from tests.fixtures import at, trips, zones

PICKUP, DROPOFF = "pickup_location_id", "dropoff_location_id"


def _ids(df):
    return sorted(r.vendor_id for r in df.collect())


def _prepared(spark, trip_df, zone_df):
    """Through the job: tables put in, ``transform`` called."""
    job = RideJob(RideConfig(), spark)
    job.tables |= {"taxi_trip_data": trip_df, "taxi_zone_geo": zone_df}
    job.transform()
    return job.tables["prepared_data"]


def test_transform_makes_every_model_feature(spark):
    raw = trips(spark, {"store_and_fwd_flag": "N"}, {"store_and_fwd_flag": "Y", "vendor_id": 9})
    made = set(TRIP_FEATURES) - set(raw.columns)
    assert made == {"month", "day_of_week", "day_of_month", "store_and_fwd_flag_is_N"}
    rows = _prepared(spark, raw, zones(spark)).select("vendor_id", *sorted(made)).orderBy("vendor_id").collect()
    # 2018-09-20 is a Thursday, day 5 of a week that starts on Sunday.
    assert [tuple(r) for r in rows] == [(1, 20, 5, 9, 1), (9, 20, 5, 9, 0)]


def test_rides_outside_the_history_have_no_features(spark):
    late = trips(spark, {"pickup_datetime": at(2022, 3, 3), "dropoff_datetime": at(2022, 3, 3)})
    assert _prepared(spark, late, zones(spark)).isEmpty()


@pytest.mark.parametrize("zone_name", ["Heliport and AIRPORT, east", "airport", "The Airports"])
def test_a_ride_from_or_to_an_excluded_zone_goes(spark, zone_name):
    # vendor 11: both elsewhere; 12 starts, 13 ends, 14 starts and ends in zone 77.
    raw = trips(
        spark,
        *({"vendor_id": v, PICKUP: p, DROPOFF: d} for v, p, d in ((11, 3, 4), (12, 77, 4), (13, 3, 77), (14, 77, 77))),
    )
    assert _ids(_prepared(spark, raw, zones(spark, {"zone_id": 77, "zone_name": "Harbour"}))) == [11, 12, 13, 14]
    assert _ids(_prepared(spark, raw, zones(spark, {"zone_id": 77, "zone_name": zone_name}))) == [11]


def test_wildcards_of_like_are_plain_characters(spark):
    cfg = PrepareConfig()
    cfg = dataclasses.replace(cfg, zone=dataclasses.replace(cfg.zone, excluded_word="a_b"))
    raw = trips(spark, {PICKUP: 1}, {PICKUP: 2})
    named = zones(spark, {"zone_id": 1, "zone_name": "axb"}, {"zone_id": 2, "zone_name": "A_B"})
    assert [r[PICKUP] for r in prepare_rides(raw, named, cfg).collect()] == [1]


def test_month_bounds(spark):
    moments = [at(2017, 3, 31, 23, 59, 59), at(2017, 4, 1, 0), at(2018, 11, 30, 23, 59, 59), at(2018, 12, 1, 0)]
    raw = trips(spark, *({"vendor_id": i, "pickup_datetime": t} for i, t in enumerate(moments)))
    assert _ids(prepare_rides(raw, zones(spark))) == [1, 2]


def test_dropoff_hour_bounds(spark):
    ends = [at(2018, 9, 20, 16, 59), at(2018, 9, 20, 17), at(2018, 9, 20, 23, 59), at(2018, 9, 21, 0)]
    raw = trips(spark, *({"vendor_id": i, PICKUP: i, "dropoff_datetime": t} for i, t in enumerate(ends)))
    assert _ids(prepare_rides(raw, zones(spark))) == [1, 2]


def test_null_location_and_flag(spark):
    raw = trips(
        spark,
        {"vendor_id": 1, PICKUP: None, "store_and_fwd_flag": None},
        {"vendor_id": 2, PICKUP: 7, "store_and_fwd_flag": "N"},
        {"vendor_id": 3, PICKUP: 100, "store_and_fwd_flag": "N"},
    )
    twice = zones(spark, *[{"zone_id": 100, "zone_name": "JFK Airport"}] * 2)
    rows = {r.vendor_id: r.store_and_fwd_flag_is_N for r in prepare_rides(raw, twice).collect()}
    assert rows == {1: 0, 2: 1}  # the null id survives the anti join, a repeated zone id does not multiply


def test_matched_only_drops_unknown_and_null_zones(spark):
    places = [(None, 2), (1, 2), (5, 2), (1, 100)]
    raw = trips(spark, *({"vendor_id": i, PICKUP: p, DROPOFF: d} for i, (p, d) in enumerate(places)))
    z = zones(spark, *({"zone_id": i, "zone_name": n} for i, n in ((1, "a"), (2, "b"), (2, "b again"), (100, "Airport"))))
    assert _ids(prepare_rides(raw, z, PrepareConfig(exclusion_mode="matched_only"))) == [1]


def test_first_n_daily_uses_tie_breaker(spark):
    t = at(2018, 9, 20, 18)
    raw = trips(
        spark,
        *({"vendor_id": v, "pickup_datetime": t + dt.timedelta(minutes=m)} for v, m in ((4, 0), (3, 0), (2, 1), (1, 2))),
    )
    cfg = PrepareConfig()
    cfg = dataclasses.replace(cfg, ride=dataclasses.replace(cfg.ride, tie_breakers=("vendor_id",)))
    assert _ids(prepare_rides(raw, zones(spark), cfg)) == [2, 3, 4]


def test_duplicates_are_removed_before_ranking(spark):
    assert prepare_rides(trips(spark, {}, {}, {}, {}), zones(spark)).count() == 1


def test_zone_table_traits_in_both_exclusion_modes(spark):
    # Traits of the shipped zone table: some ids repeated, some missing, airports at 1, 132 and 138.
    named = [(1, "Newark Airport"), (132, "JFK Airport"), (138, "LaGuardia Airport"), (56, "Corona"), (56, "Corona"),
             (103, "Liberty Island"), (103, "Ellis Island"), (7, "Astoria"), (263, "Yorkville West")]
    z = zones(spark, *({"zone_id": i, "zone_name": n} for i, n in named))
    places = [(56, 7), (103, 7), (264, 7), (132, 7), (7, 138), (7, 1), (7, 263)]
    raw = trips(spark, *({"vendor_id": i, PICKUP: p, DROPOFF: d} for i, (p, d) in enumerate(places, 1)))
    assert _ids(prepare_rides(raw, z)) == [1, 2, 3, 7]  # repeated ids do not multiply, an unknown id survives
    assert _ids(prepare_rides(raw, z, PrepareConfig(exclusion_mode="matched_only"))) == [1, 2, 7]
