from pathlib import Path

import pytest

from rideflow.operators.rides import PrepareConfig
from rideflow.plans.catalog import EVENT_PREPARE
from rideflow.sources.tables import TABLE_SCHEMAS, table
from rideflow.streaming.events import file_stream, filter_ride_stream, stream_filtered

SF = "/root/testdata/sf0.001"


def _events(spark):
    return file_stream(spark, f"{SF}/events.parque[t]", TABLE_SCHEMAS["events"])


@pytest.mark.skipif(not Path(SF, "events.parquet").exists(), reason="driver tables not present")
def test_stream_equals_batch(spark):
    streamed = stream_filtered(_events(spark), table(spark, SF, "customer"), EVENT_PREPARE)
    batch = filter_ride_stream(table(spark, SF, "events"), table(spark, SF, "customer"), EVENT_PREPARE)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert isinstance(EVENT_PREPARE, PrepareConfig)


@pytest.mark.skipif(not Path(SF, "events.parquet").exists(), reason="driver tables not present")
def test_rerun_resumes_without_duplicates(spark):
    from rideflow.session import scratch_path

    root = scratch_path(spark, "stream-resume")
    customers = table(spark, SF, "customer")
    first = stream_filtered(_events(spark), customers, EVENT_PREPARE, sink_root=root).count()
    again = stream_filtered(_events(spark), customers, EVENT_PREPARE, sink_root=root).count()
    assert first == again > 0
