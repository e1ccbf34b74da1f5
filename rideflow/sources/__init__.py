"""Sources and sinks."""

from rideflow.sources.sinks import free_scratch, materialize, save_model, save_table
from rideflow.sources.tables import (
    TABLE_SCHEMAS,
    TRIP_SCHEMA,
    ZONE_SCHEMA,
    TableSpec,
    extract,
    load_tables,
    read_table,
    table,
)

__all__ = [
    "TABLE_SCHEMAS",
    "TRIP_SCHEMA",
    "ZONE_SCHEMA",
    "TableSpec",
    "extract",
    "free_scratch",
    "load_tables",
    "materialize",
    "read_table",
    "save_model",
    "save_table",
    "table",
]
