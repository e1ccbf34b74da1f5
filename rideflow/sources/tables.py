"""Scans with explicit schemas.

Schema inference costs an extra pass over the files and silently changes
types when the data changes, so every scan here takes an explicit schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The schemas of the ride and zone tables and of the driver's
# test tables, column by column in their natural order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.LongType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("rate_code", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("imp_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("zone_id", T.LongType()),
        T.StructField("zone_name", T.StringType()),
        T.StructField("borough", T.StringType()),
    ]
)

_NTZ = T.TimestampNTZType()

TABLE_SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType(
        [T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]
    ),
    "nation": T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType()),
            T.StructField("n_name", T.StringType()),
            T.StructField("n_regionkey", T.IntegerType()),
        ]
    ),
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "supplier": T.StructType(
        [
            T.StructField("s_suppkey", T.LongType()),
            T.StructField("s_name", T.StringType()),
            T.StructField("s_nationkey", T.IntegerType()),
            T.StructField("s_acctbal", T.DoubleType()),
        ]
    ),
    "part": T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_brand", T.StringType()),
            T.StructField("p_type", T.StringType()),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", _NTZ),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "lineitem": T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_extendedprice", T.DoubleType()),
            T.StructField("l_discount", T.DoubleType()),
            T.StructField("l_tax", T.DoubleType()),
            T.StructField("l_returnflag", T.StringType()),
            T.StructField("l_linestatus", T.StringType()),
            T.StructField("l_shipdate", _NTZ),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", _NTZ),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
}


@dataclass(frozen=True)
class TableSpec:
    """Where a named dataset lives and how to read it."""

    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = None
    header: bool = True


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    header: bool = True,
) -> DataFrame:
    """Read one table (S1 CSV, S2 Parquet / default format).

    CSV needs a schema: inference would scan the file twice.  With a header its
    columns are found by name, in any order, and other columns are left out;
    without one they are taken by position.  Other formats carry their own
    schema; passing one pins the expected columns and types.  A column that is
    missing, or of another type, raises ``ValueError``; a CSV value that does
    not fit its type fails the job.
    """
    reader = spark.read
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV scans need an explicit schema")
        if not header:
            return reader.schema(schema).option("mode", "FAILFAST").csv(path)
        # Only the header line is read here: without a schema every column is text.
        found = reader.option("header", "true").option("mode", "FAILFAST").csv(path)
        _require_columns(path, schema, {c: None for c in found.columns})
        return found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    if schema is None:
        return reader.format(fmt).load(path)
    found = reader.format(fmt).load(path)
    _require_columns(path, schema, {f.name: f.dataType for f in found.schema})
    return reader.schema(schema).format(fmt).load(path)


def _require_columns(path: str, schema: T.StructType, found: Mapping[str, T.DataType | None]) -> None:
    missing = [f.name for f in schema if f.name not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(found)}")
    other = [f"{f.name} ({found[f.name].simpleString()}, not {f.dataType.simpleString()})" for f in schema
             if found[f.name] is not None and found[f.name].simpleString() != f.dataType.simpleString()]
    if other:
        raise ValueError(f"{path} has columns of other types: {', '.join(other)}")


def extract(spark: SparkSession, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    """Multi-dataset extract by name (S3): one lazy scan per entry."""
    return {
        name: read_table(spark, spec.path, spec.fmt, spec.schema, spec.header)
        for name, spec in specs.items()
    }


def load_tables(
    spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The driver's Parquet tables of one scale factor, by name."""
    chosen = list(names) if names is not None else list(TABLE_SCHEMAS)
    return extract(
        spark,
        {
            name: TableSpec(f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet", TABLE_SCHEMAS.get(name))
            for name in chosen
        },
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Shorthand for a single driver table."""
    return load_tables(spark, sf_dir, [name])[name]
