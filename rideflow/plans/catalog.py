"""Named queries over the driver's tables, each with an independent DuckDB oracle.

The taxi notions map onto the test tables like this: a ride with a time of day
is an ``events`` row (``ts``, ``user_id`` as its zone, ``event_type`` as its
flag); the zone dimension is ``customer`` (``c_mktsegment`` holding the word
to exclude) or ``part`` (``p_name``); rides with a start and an end are
``orders`` joined to ``lineitem``; monetary columns are lineitem's.

Every query reads whole tables.  A query whose result depends on random
numbers or on a fitted model has no oracle entry (row-count check only).
"""

from __future__ import annotations

from collections.abc import Callable
import uuid
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.functions.columns import clamp, doubled_unix_date, name_contains, scale_if
from rideflow.functions.udfs import ceil_int, ceil_udf, cos_float, cos_udf
from rideflow.operators import aggregates as agg
from rideflow.operators import charts, filters, joins, multisets, nested, projections, quantiles, sampling, sketches, temporal, windows
from rideflow.operators.rides import PrepareConfig, RideColumns, ZoneColumns, prepare_rides
from rideflow.plans import ml
from rideflow.plans.job import RideConfig, RideJob
from rideflow.session import scratch_path
from rideflow.sources.sinks import materialize, save_model, save_table
from rideflow.sources.tables import TABLE_SCHEMAS, TableSpec, load_tables, read_table, table
from rideflow.streaming.events import file_stream, stream_filtered
from rideflow.streaming.first_n import stream_first_n

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return register


def _key_sql(*columns: str) -> str:
    """The text that samples and batches hash."""
    return " || ".join(
        f"coalesce('v' || CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), 'n')" for c in columns
    )


# --- the flagship: events as rides, customers as zones ---------------------

# The event-table stand-ins for the ride job's parameters.
EVENT_PREPARE = PrepareConfig(
    after_month="202312",
    through_month="202401",
    first_hour=17,
    last_hour=23,
    rides_per_day=3,
    ride=RideColumns(
        pickup_ts="ts",
        dropoff_ts="ts",
        locations=("user_id",),
        flag="event_type",
        flag_value="click",
        tie_breakers=("event_id",),
    ),
    zone=ZoneColumns(key="c_custkey", name="c_mktsegment", excluded_word="auto"),
)
EVENT_OUTPUT = [
    "event_id",
    "ts",
    "user_id",
    "event_type",
    "value",
    "month",
    "day_of_week",
    "day_of_month",
    "event_type_is_click",
]


def prepared_events(spark: SparkSession, sf_dir: str, cfg: PrepareConfig = EVENT_PREPARE) -> DataFrame:
    t = load_tables(spark, sf_dir, ["events", "customer"])
    return prepare_rides(t["events"], t["customer"], cfg).select(*EVENT_OUTPUT)


def _prepared_sql(n: int, exclusion: str) -> str:
    return f"""
WITH f AS (SELECT e.* FROM (SELECT DISTINCT * FROM events) e
  WHERE strftime(ts, '%Y%m') > '202312' AND strftime(ts, '%Y%m') <= '202401'
    AND hour(ts) BETWEEN 17 AND 23
    AND {exclusion}),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM f)
SELECT event_id, ts, user_id, event_type, value,
       CAST(month(ts) AS INTEGER) AS "month", CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(day(ts) AS INTEGER) AS day_of_month,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_is_click
FROM r WHERE rn <= {n}
"""


_ANTI_AUTO = (
    "NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id "
    "AND lower(c.c_mktsegment) LIKE '%auto%')"
)
_MATCHED_NOT_AUTO = (
    "EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id "
    "AND NOT (lower(c.c_mktsegment) LIKE '%auto%'))"
)

query("prepared_events", _prepared_sql(3, _ANTI_AUTO))(prepared_events)


@query("prepared_events_n2", _prepared_sql(2, _ANTI_AUTO))
def prepared_events_n2(spark, sf_dir):
    return prepared_events(spark, sf_dir, replace(EVENT_PREPARE, rides_per_day=2))


@query("prepared_events_matched_only", _prepared_sql(3, _MATCHED_NOT_AUTO))
def prepared_events_matched_only(spark, sf_dir):
    return prepared_events(spark, sf_dir, replace(EVENT_PREPARE, exclusion_mode="matched_only"))


# The customers that are known as zones: some ids have no row, so the two exclusion modes differ.
_KNOWN = "c_custkey % 7 <> 3"

# Two locations, a drop-off hour of its own, and a dimension with missing ids.
TWO_ZONE_PREPARE = replace(
    EVENT_PREPARE, ride=replace(EVENT_PREPARE.ride, dropoff_ts="drop_ts", locations=("user_id", "k"))
)
# Orders as rides: the month range cuts.
ORDER_PREPARE = PrepareConfig(
    after_month="199703",
    through_month="199811",
    first_hour=17,
    last_hour=23,
    rides_per_day=1,
    ride=RideColumns(
        pickup_ts="o_orderdate",
        dropoff_ts="drop_ts",
        locations=("o_custkey",),
        flag="o_orderstatus",
        flag_value="F",
        tie_breakers=("o_orderkey",),
    ),
    zone=ZoneColumns(key="c_custkey", name="c_mktsegment", excluded_word="auto"),
)


def _two_zone_events(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    t = load_tables(spark, sf_dir, ["events", "customer"])
    rides = t["events"].withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    rides = rides.withColumn("drop_ts", F.col("ts") + F.make_interval(mins=F.col("k").cast("int")))
    cfg = replace(TWO_ZONE_PREPARE, exclusion_mode=mode)
    return prepare_rides(rides, t["customer"].filter(_KNOWN), cfg).select(*EVENT_OUTPUT, "k")


def _exclusion_sql(column: str, mode: str) -> str:
    known = f"SELECT 1 FROM customer c WHERE {_KNOWN} AND c.c_custkey = {column}"
    if mode == "anti":
        return f"NOT EXISTS ({known} AND lower(c.c_mktsegment) LIKE '%auto%')"
    return f"EXISTS ({known} AND NOT (lower(c.c_mktsegment) LIKE '%auto%'))"


def _two_zone_sql(mode: str) -> str:
    return f"""
WITH e AS (SELECT DISTINCT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
f AS (SELECT e.* FROM e WHERE strftime(ts, '%Y%m') > '202312' AND strftime(ts, '%Y%m') <= '202401'
    AND hour(ts + to_minutes(k)) BETWEEN 17 AND 23
    AND {_exclusion_sql("e.user_id", mode)} AND {_exclusion_sql("e.k", mode)}),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM f)
SELECT event_id, ts, user_id, event_type, value, k,
       CAST(month(ts) AS INTEGER) AS "month", CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       CAST(day(ts) AS INTEGER) AS day_of_month,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_is_click
FROM r WHERE rn <= 3"""


@query("two_zone_events", _two_zone_sql("anti"))
def two_zone_events(spark, sf_dir):
    return _two_zone_events(spark, sf_dir, "anti")


@query("two_zone_events_matched_only", _two_zone_sql("matched_only"))
def two_zone_events_matched_only(spark, sf_dir):
    return _two_zone_events(spark, sf_dir, "matched_only")


_PREPARED_ORDERS_SQL = """
WITH o AS (SELECT DISTINCT *, o_orderdate + to_hours(o_orderkey % 24) AS drop_ts FROM orders),
f AS (SELECT o.* FROM o WHERE strftime(o_orderdate, '%Y%m') > '199703' AND strftime(o_orderdate, '%Y%m') <= '199811'
    AND hour(drop_ts) BETWEEN 17 AND 23 AND {exclusion}),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderdate, o_orderkey) AS rn FROM f)
SELECT o_orderkey, o_custkey, o_orderdate, CAST(month(o_orderdate) AS INTEGER) AS "month",
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_orderstatus_is_F FROM r WHERE rn <= 1"""


def _prepared_orders(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    t = load_tables(spark, sf_dir, ["orders", "customer"])
    hours = (F.col("o_orderkey") % 24).cast("int")
    rides = t["orders"].withColumn("drop_ts", F.col("o_orderdate") + F.make_interval(hours=hours))
    done = prepare_rides(rides, t["customer"].filter(_KNOWN), replace(ORDER_PREPARE, exclusion_mode=mode))
    return done.select("o_orderkey", "o_custkey", "o_orderdate", "month", "o_orderstatus_is_F")


@query("prepared_orders", _PREPARED_ORDERS_SQL.format(exclusion=_exclusion_sql("o.o_custkey", "anti")))
def prepared_orders(spark, sf_dir):
    return _prepared_orders(spark, sf_dir, "anti")


@query("prepared_orders_matched_only", _PREPARED_ORDERS_SQL.format(exclusion=_exclusion_sql("o.o_custkey", "matched_only")))
def prepared_orders_matched_only(spark, sf_dir):
    return _prepared_orders(spark, sf_dir, "matched_only")


# --- aggregates -------------------------------------------------------------


@query(
    "top_priorities",
    """SELECT o_orderpriority, count(*) AS "count" FROM orders
       GROUP BY o_orderpriority ORDER BY "count" DESC, o_orderpriority LIMIT 3""",
)
def top_priorities(spark, sf_dir):
    return agg.top_values(table(spark, sf_dir, "orders"), "o_orderpriority", 3)


def _shares_sql(tab: str, col: str, fmt: str) -> str:
    share = f'100.0::DOUBLE * "count" / sum("count") OVER ()'
    return f"""WITH c AS (SELECT {col}, count(*) AS "count" FROM {tab} GROUP BY {col})
SELECT {col}, "count", {share} AS share, printf('{fmt}', {share}) AS percentage FROM c"""


@query("segment_shares", _shares_sql("customer", "c_mktsegment", "%2.2f%%"))
def segment_shares(spark, sf_dir):
    return agg.value_shares(table(spark, sf_dir, "customer"), "c_mktsegment", "%2.2f%%")


@query("status_shares", _shares_sql("orders", "o_orderstatus", "%.1f%%"))
def status_shares(spark, sf_dir):
    return agg.value_shares(table(spark, sf_dir, "orders"), "o_orderstatus", "%.1f%%")


@query(
    "orders_in_month",
    "SELECT count(*) AS n_rows FROM orders WHERE strftime(o_orderdate, '%m%Y') = '051998'",
)
def orders_in_month(spark, sf_dir):
    return agg.row_count(filters.in_month(table(spark, sf_dir, "orders"), "o_orderdate", "199805"))


@query(
    "history_range",
    """SELECT * FROM orders WHERE strftime(o_orderdate, '%Y%m') > '199703'
       AND strftime(o_orderdate, '%Y%m') <= '199811'""",
)
def history_range(spark, sf_dir):
    return filters.limit_history(table(spark, sf_dir, "orders"), "o_orderdate", "199703", "199811")


@query(
    "max_in_hour",
    "SELECT max(value) AS max_value FROM events WHERE hour(ts) = 17 AND event_type = 'purchase'",
)
def max_in_hour(spark, sf_dir):
    ev = filters.keep_hours(table(spark, sf_dir, "events"), "ts", 17, 17)
    return agg.max_where(ev, "value", F.col("event_type") == "purchase", "max_value")


@query(
    "group_stats",
    """SELECT l_returnflag, count(*) AS n_rows, max(l_quantity) AS max_l_quantity
       FROM lineitem GROUP BY l_returnflag""",
)
def group_stats(spark, sf_dir):
    return agg.group_stats(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity")


@query(
    "dedup_orders",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
       (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def dedup_orders(spark, sf_dir):
    return agg.dedup_first(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])


@query(
    "dedup_per_name",
    """SELECT p_name, count(*) AS "count" FROM (SELECT DISTINCT p_name FROM part) GROUP BY p_name""",
)
def dedup_per_name(spark, sf_dir):
    kept = agg.dedup_first(table(spark, sf_dir, "part"), "p_name", ["p_partkey"])
    return kept.groupBy("p_name").agg(F.count(F.lit(1)).alias("count"))


@query(
    "duplicate_line_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def duplicate_line_keys(spark, sf_dir):
    return agg.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedup_report",
    """SELECT CAST(sum(c) AS BIGINT) AS n_before, count(*) AS n_after
       FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def dedup_report(spark, sf_dir):
    return agg.dedup_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_lines", "SELECT DISTINCT * FROM lineitem")
def distinct_lines(spark, sf_dir):
    return agg.dedup_all(table(spark, sf_dir, "lineitem"))


@query(
    "collected_quantities",
    """SELECT l_returnflag, l_linestatus,
         string_agg(CAST(l_quantity AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY l_quantity)
           AS quantities_text,
         CAST(sum(n) AS BIGINT) AS n_quantities
       FROM (SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n FROM lineitem
             GROUP BY l_returnflag, l_linestatus, l_quantity)
       GROUP BY l_returnflag, l_linestatus""",
)
def collected_quantities(spark, sf_dir):
    got = agg.collect_values(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "quantities"
    )
    text = F.array_join(
        F.transform("quantities", lambda x: F.concat(x["value"].cast("string"), F.lit(":"), x["n"].cast("string"))),
        ",",
    )
    return got.select("l_returnflag", "l_linestatus", text.alias("quantities_text"), "n_quantities")


@query(
    "prices_per_flag",
    """SELECT l_returnflag, l_linestatus, l_extendedprice, count(*) AS n FROM lineitem
       GROUP BY l_returnflag, l_linestatus, l_extendedprice""",
)
def prices_per_flag(spark, sf_dir):
    return agg.values_per_group(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")


# --- row expressions and projections ----------------------------------------


@query(
    "scaled_if",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax,
       CASE WHEN l_partkey <> l_suppkey THEN l_tax * 0.5 ELSE l_tax END AS new_tax FROM lineitem""",
)
def scaled_if(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_tax",
        scale_if(F.col("l_partkey") != F.col("l_suppkey"), "l_tax", 0.5).alias("new_tax"),
    )


@query(
    "clamped_balance",
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal > 5000 THEN 5000
       ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def clamped_balance(spark, sf_dir):
    cu = table(spark, sf_dir, "customer")
    return cu.select("c_custkey", "c_name", clamp("c_acctbal", 0, 5000).alias("c_acctbal"))


@query(
    "scaled_columns",
    """SELECT l_orderkey, l_linenumber, l_quantity * 10 AS "l_quantity * 10",
       l_extendedprice * 15 AS "l_extendedprice * 15", l_discount * 10 AS "l_discount * 10",
       l_tax * 5 AS "l_tax * 5", l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
)
def scaled_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return projections.scale_columns(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query(
    "head_rows",
    "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
)
def head_rows(spark, sf_dir):
    return projections.head_rows(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


@query(
    "ceil_udf",
    """SELECT l_orderkey, l_linenumber, l_extendedprice,
       CAST(ceil(l_extendedprice / 100) AS INTEGER) AS price_hundreds_up FROM lineitem""",
)
def ceil_udf_query(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        ceil_udf(F.col("l_extendedprice") / 100).alias("price_hundreds_up"),
    )


@query(
    "cos_udf",
    """SELECT l_orderkey, l_linenumber, l_discount, CAST(cos(l_discount) AS FLOAT) AS cos_discount
       FROM lineitem""",
)
def cos_udf_query(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_discount", cos_udf("l_discount").alias("cos_discount"))


@query("ceil_native", ORACLE_SQL["ceil_udf"])
def ceil_native(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    up = ceil_int(F.col("l_extendedprice") / 100).alias("price_hundreds_up")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", up)


@query("cos_native", ORACLE_SQL["cos_udf"])
def cos_native(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_discount", cos_float("l_discount").alias("cos_discount"))


# --- time -------------------------------------------------------------------


@query(
    "overnight",
    """SELECT o.o_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate,
         CAST(datediff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS date_diff,
         strftime(o.o_orderdate, '%B %-d, %Y') AS o_orderdate_text,
         strftime(l.l_shipdate, '%B %-d, %Y') AS l_shipdate_text
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
       WHERE datediff('day', o.o_orderdate, l.l_shipdate) > 0""",
)
def overnight(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["orders", "lineitem"])
    rides = t["orders"].select("o_orderkey", "o_orderdate").join(
        t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate"),
        F.col("o_orderkey") == F.col("l_orderkey"),
    )
    kept = filters.overnight_only(rides, "o_orderdate", "l_shipdate")
    return projections.format_dates(kept, ["o_orderdate", "l_shipdate"]).drop("l_orderkey")


@query(
    "weekend_orders",
    """SELECT *, CASE WHEN dayofweek(o_orderdate) = 0 THEN 'Sunday' ELSE 'Saturday' END AS day_of_week
       FROM orders WHERE dayofweek(o_orderdate) IN (0, 6)""",
)
def weekend_orders(spark, sf_dir):
    return filters.weekend_only(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "on_unix_day",
    "SELECT * FROM events WHERE CAST(ts AS DATE) = CAST(make_timestamp(CAST(1704900000 AS BIGINT) * 1000000) AS DATE)",
)
def on_unix_day(spark, sf_dir):
    return filters.on_unix_day(table(spark, sf_dir, "events"), "ts", "1704900000")


@query(
    "doubled_date",
    """SELECT event_id, ts, CAST(2 * floor(epoch(ts)) AS BIGINT) AS ts_doubled,
       CAST(make_timestamp(CAST(2 * floor(epoch(ts)) AS BIGINT) * 1000000) AS DATE) AS doubled_date
       FROM events""",
)
def doubled_date(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "ts",
        (F.unix_timestamp("ts") * 2).alias("ts_doubled"),
        doubled_unix_date("ts").alias("doubled_date"),
    )


# --- joins ------------------------------------------------------------------


@query(
    "join_count_segment",
    """SELECT count(*) AS n_rows FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE o.o_orderpriority = '1-URGENT' AND c.c_mktsegment = 'BUILDING'""",
)
def join_count_segment(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["orders", "customer"])
    urgent = t["orders"].filter(F.col("o_orderpriority") == "1-URGENT")
    joined = joins.join_dim(urgent, t["customer"], "o_custkey", "c_custkey", F.col("c_mktsegment") == "BUILDING")
    return agg.row_count(joined)


_LINE_ORDER = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _line_order_without(*first: str) -> list[str]:
    return [c for c in _LINE_ORDER if c not in first]


@query(
    "longest_cheap",
    f"""SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, p.p_name
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       WHERE l.l_linenumber = 1 AND p.p_brand = 'Brand#13' AND l.l_extendedprice < 20000
       ORDER BY l.l_quantity DESC, {", ".join("l." + c for c in _line_order_without("l_quantity"))} LIMIT 5""",
)
def longest_cheap(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["lineitem", "part"])
    single = t["lineitem"].filter(F.col("l_linenumber") == 1)
    joined = joins.join_dim(single, t["part"], "l_partkey", "p_partkey", F.col("p_brand") == "Brand#13")
    cheap = joined.filter(F.col("l_extendedprice") < 20000)
    order = [F.desc("l_quantity"), *[F.asc(c) for c in _line_order_without("l_quantity")]]
    return joins.top_by(cheap, order, 5).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "p_name"
    )


@query(
    "labelled_lines",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name AS ordered_p_name,
       p.p_brand AS ordered_p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
)
def labelled_lines(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["lineitem", "part"])
    part = t["part"].select("p_partkey", "p_name", "p_brand")
    return joins.label_dim(t["lineitem"], part, "l_partkey", "p_partkey", "ordered_").select(
        "l_orderkey", "l_linenumber", "l_partkey", "ordered_p_name", "ordered_p_brand"
    )


@query(
    "left_enrich",
    """SELECT c.c_custkey, c.c_name, c.c_mktsegment, a.n_urgent FROM customer c LEFT JOIN
       (SELECT o_custkey AS c_custkey, count(*) AS n_urgent FROM orders
        WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) a ON c.c_custkey = a.c_custkey""",
)
def left_enrich(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["orders", "customer"])
    urgent = (
        t["orders"]
        .filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_urgent"))
    )
    customers = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return joins.enrich_left(customers, urgent, "c_custkey")


@query(
    "excluded_by_dim",
    """SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p
       WHERE p.p_partkey = l.l_partkey AND lower(p.p_name) LIKE '%ring%')""",
)
def excluded_by_dim(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["lineitem", "part"])
    return joins.exclude_by_dim(t["lineitem"], "l_partkey", t["part"], "p_partkey", name_contains("p_name", "ring"))


@query(
    "excluded_matched_only",
    """SELECT * FROM lineitem l WHERE EXISTS (SELECT 1 FROM part p
       WHERE p.p_partkey = l.l_partkey AND NOT (lower(p.p_name) LIKE '%ring%'))""",
)
def excluded_matched_only(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["lineitem", "part"])
    return joins.exclude_by_dim(
        t["lineitem"], "l_partkey", t["part"], "p_partkey", name_contains("p_name", "ring"), mode="matched_only"
    )


@query(
    "chain_pairs",
    """SELECT a.k AS chain_key, a.n AS n_left, b.n AS n_right, CAST(a.n * b.n AS DECIMAL(38,0)) AS n_pairs
       FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1) a
       JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey IS NOT NULL GROUP BY 1) b
       ON a.k = b.k""",
)
def chain_pairs(spark, sf_dir):
    t = load_tables(spark, sf_dir, ["customer", "supplier"])
    return joins.chain_pairs(t["customer"], "c_nationkey", t["supplier"], "s_nationkey")


@query(
    "chain_pair_count",
    "SELECT CAST(count(*) AS DECIMAL(38,0)) AS n_pairs FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_partkey",
)
def chain_pair_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return joins.chain_pair_count(li, "l_suppkey", li, "l_partkey")


_PAIR_SAMPLE_BOUND = sampling.md5_threshold(0.1)


@query(
    "sampled_chain_pair_count",
    f"""WITH s AS (SELECT * FROM lineitem WHERE md5({_key_sql("l_orderkey")}) < '{_PAIR_SAMPLE_BOUND}')
       SELECT CAST(count(*) AS DECIMAL(38,0)) AS n_pairs FROM s a JOIN s b ON a.l_suppkey = b.l_partkey""",
)
def sampled_chain_pair_count(spark, sf_dir):
    """J7 as the course does it: one sample (10 % of orders), used on both sides, then counted."""
    sample = sampling.hash_sample(table(spark, sf_dir, "lineitem"), "l_orderkey", 0.1)
    return joins.chain_pair_count(sample, "l_suppkey", sample, "l_partkey")


@query(
    "batch_pair_counts",
    f"""WITH s AS (SELECT *, CAST('0x' || substr(md5({_key_sql(*_LINE_ORDER)}), 1, 8) AS BIGINT) % 1000 AS batch FROM lineitem),
       n AS (SELECT batch, count(*) AS n FROM s JOIN lineitem b ON s.l_suppkey = b.l_partkey WHERE batch < 10 GROUP BY batch)
       SELECT CAST(r.range AS INTEGER) AS batch, CAST(coalesce(n.n, 0) AS DECIMAL(38,0)) AS n_pairs
       FROM range(10) r LEFT JOIN n ON n.batch = r.range""",
)
def batch_pair_counts(spark, sf_dir):
    """Ten disjoint batches of a thousandth of the lines, each scored against the whole table."""
    li = table(spark, sf_dir, "lineitem")
    batches = sampling.disjoint_batches(li, _LINE_ORDER, 10, 1000, spark)
    return joins.batch_pair_counts(batches, "batch", "l_suppkey", li, "l_partkey", 10)


# --- windows ----------------------------------------------------------------


@query(
    "latest_3",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
       ORDER BY o_orderdate DESC, o_orderkey DESC) AS row_number FROM orders) WHERE row_number <= 3""",
)
def latest_3(spark, sf_dir):
    return windows.latest_n(
        table(spark, sf_dir, "orders"), "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")], 3
    )


@query(
    "first_n_daily",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
       ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 3""",
)
def first_n_daily(spark, sf_dir):
    return windows.first_n_daily(table(spark, sf_dir, "events"), "user_id", "ts", 3, ["event_id"])


# The order of lineitem rows for running sums: ship date first, then every
# other column, which makes it total (lineitem has no repeated rows).
_RUN_ORDER = ["l_shipdate", *_line_order_without("l_shipdate", "l_returnflag")]
_RUN_ORDER_SQL = ", ".join(_RUN_ORDER)
_TAX = "CAST(l_tax AS DECIMAL(12,2))"
RUN_BUCKETS = "auto"


@query(
    "running_tax",
    f"""SELECT *, CAST(sum({_TAX}) OVER (PARTITION BY l_returnflag ORDER BY {_RUN_ORDER_SQL}
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_tax FROM lineitem""",
)
def running_tax(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    summed = windows.running_sum(
        li, F.col("l_tax").cast("decimal(12,2)"), "l_returnflag", _RUN_ORDER, "running_tax", buckets=RUN_BUCKETS
    )
    # Exact decimal sums, reported as double.
    return summed.withColumn("running_tax", F.col("running_tax").cast("double"))


@query(
    "running_order_value",
    """SELECT *, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority
       ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS running_value
       FROM orders""",
)
def running_order_value(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    value = F.col("o_totalprice").cast("decimal(18,2)")
    return windows.running_sum(
        orders, value, "o_orderpriority", ["o_orderdate", "o_orderkey"], "running_value", buckets=RUN_BUCKETS
    )


_RUN_SQL = f"""WITH r AS (SELECT l_returnflag, l_linestatus,
  sum({_TAX}) OVER w AS run, row_number() OVER w AS pos FROM lineitem
  WINDOW w AS (PARTITION BY l_returnflag, l_linestatus ORDER BY {_RUN_ORDER_SQL}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(
    "rows_to_reach",
    _RUN_SQL
    + """
SELECT l_returnflag, l_linestatus, CAST(CASE WHEN max(run) >= 5 THEN count(*) END AS BIGINT) AS rows_count
FROM r WHERE run <= 5 GROUP BY l_returnflag, l_linestatus""",
)
def rows_to_reach(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return windows.rows_to_reach(
        li,
        F.col("l_tax").cast("decimal(12,2)"),
        ["l_returnflag", "l_linestatus"],
        _RUN_ORDER,
        5,
        buckets=RUN_BUCKETS,
    )


@query(
    "rows_to_reach_first",
    _RUN_SQL
    + """
SELECT l_returnflag, l_linestatus, CAST(min(CASE WHEN run >= 5 THEN pos END) AS BIGINT) AS rows_count
FROM r GROUP BY l_returnflag, l_linestatus""",
)
def rows_to_reach_first(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return windows.rows_to_reach(
        li,
        F.col("l_tax").cast("decimal(12,2)"),
        ["l_returnflag", "l_linestatus"],
        _RUN_ORDER,
        5,
        mode="first_crossing",
        buckets=RUN_BUCKETS,
    )


# --- nested data ------------------------------------------------------------

_CONTRIBUTIONS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TOTAL_SQL = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


def _structured_lines(li: DataFrame) -> DataFrame:
    """Lines with ``payments = struct(contributions = struct(4 columns), l_total)``."""
    with_total = li.withColumn(
        "l_total", F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * (F.lit(1) + F.col("l_tax"))
    )
    packed = nested.pack(with_total, _CONTRIBUTIONS, "contributions")
    return nested.pack(packed, ["contributions", "l_total"], "payments")


@query(
    "packed_payments",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_tax AS tax, {_TOTAL_SQL} AS total,
       l_quantity AS quantity FROM lineitem""",
)
def packed_payments(spark, sf_dir):
    s = _structured_lines(table(spark, sf_dir, "lineitem"))
    s = nested.unpack_field(s, "payments.contributions.l_tax", "tax")
    s = nested.unpack_field(s, "payments.l_total", "total")
    s = nested.unpack_field(s, "payments.contributions.l_quantity", "quantity")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "tax", "total", "quantity")


def _latest_order():
    return [F.desc("l_shipdate"), *[F.asc(c) for c in _line_order_without("l_shipdate")]]


def _payment_struct():
    """``struct(contributions = struct(4 columns), l_total)`` as one expression."""
    contributions = F.struct(*[F.col(c) for c in _CONTRIBUTIONS]).alias("contributions")
    total = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * (F.lit(1) + F.col("l_tax"))
    return F.struct(contributions, total.alias("l_total"))


_LATEST_ORDER_SQL = "l_shipdate DESC, " + ", ".join(_line_order_without("l_shipdate"))


def _latest_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 latest payment structs per supplier as one array."""
    li = table(spark, sf_dir, "lineitem")
    return windows.latest_n_array(li, "l_suppkey", _latest_order(), _payment_struct(), 5, out="payments")


_LATEST_SQL = f"""WITH p AS (SELECT *, {_TOTAL_SQL} AS l_total, row_number() OVER
  (PARTITION BY l_suppkey ORDER BY {_LATEST_ORDER_SQL}) AS rn FROM lineitem)"""


@query(
    "exploded_payments",
    _LATEST_SQL
    + """
SELECT l_suppkey, l_total, l_quantity, l_extendedprice, l_discount, l_tax FROM p WHERE rn <= 5""",
)
def exploded_payments(spark, sf_dir):
    rows = nested.explode_rows(_latest_payments(spark, sf_dir), "payments")
    rows = nested.unpack_field(rows, "payments.l_total", "l_total")
    rows = nested.unpack_all(rows, "payments.contributions")
    return rows.drop("payments")


@query(
    "third_payment",
    _LATEST_SQL
    + """,
t AS (SELECT l_suppkey AS s_suppkey, max(CASE WHEN rn = 3 THEN l_tax END) AS third_tax
      FROM p WHERE rn <= 5 GROUP BY l_suppkey)
SELECT t.s_suppkey, s.s_name, t.third_tax FROM t LEFT JOIN supplier s ON t.s_suppkey = s.s_suppkey""",
)
def third_payment(spark, sf_dir):
    arr = _latest_payments(spark, sf_dir)
    third = arr.select(
        F.col("l_suppkey").alias("s_suppkey"),
        nested.nth_element(F.col("payments.contributions.l_tax"), 2).alias("third_tax"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return joins.enrich_left(third, suppliers, "s_suppkey").select("s_suppkey", "s_name", "third_tax")


@query(
    "latest_taxes",
    _LATEST_SQL
    + """
SELECT l_suppkey, CAST(rn - 1 AS INTEGER) AS place, l_tax FROM p WHERE rn <= 5""",
)
def latest_taxes(spark, sf_dir):
    """A field of an array of structs, then one row per element with its place."""
    arr = _latest_payments(spark, sf_dir)
    taxes = nested.array_field("payments.contributions", "l_tax")
    return arr.select("l_suppkey", F.posexplode(taxes).alias("place", "l_tax"))


@query(
    "urgent_totals_outer",
    """SELECT c.c_custkey, o.o_totalprice AS total FROM customer c LEFT JOIN
       (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000) o
       ON c.c_custkey = o.o_custkey""",
)
def urgent_totals_outer(spark, sf_dir):
    """Customers with the array of their largest urgent orders, exploded; those without keep a null row."""
    t = load_tables(spark, sf_dir, ["orders", "customer"])
    large = t["orders"].filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
    totals = large.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list("o_totalprice").alias("total"))
    customers = joins.enrich_left(t["customer"].select("c_custkey"), totals, "c_custkey")
    return nested.explode_rows(customers, "total", outer=True)


# --- sampling, batches, sinks ----------------------------------------------

_SAMPLE_BOUND = sampling.md5_threshold(0.1)


@query(
    "hash_sample",
    f"SELECT * FROM orders WHERE md5({_key_sql('o_orderkey')}) < '{_SAMPLE_BOUND}'",
)
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(table(spark, sf_dir, "orders"), "o_orderkey", 0.1)


@query("row_sample", f"SELECT * FROM lineitem WHERE md5({_key_sql(*_LINE_ORDER)}) < '{_SAMPLE_BOUND}'")
def row_sample(spark, sf_dir):
    return sampling.row_sample(table(spark, sf_dir, "lineitem").select(*_LINE_ORDER), 0.1)


# Every third nation key is missing, so that the key holds nulls.
_NULL_KEY = "CASE WHEN c_nationkey % 3 <> 0 THEN c_nationkey END"


@query("sample_with_nulls", f"SELECT c_custkey, c_name FROM customer WHERE md5({_key_sql(_NULL_KEY)}) < '{sampling.md5_threshold(0.6)}'")
def sample_with_nulls(spark, sf_dir):
    keyed = table(spark, sf_dir, "customer").withColumn("key", F.expr(_NULL_KEY))
    return sampling.hash_sample(keyed, "key", 0.6).select("c_custkey", "c_name")


_SPLIT_BOUND = sampling.md5_threshold(0.2)


@query(
    "hash_split_rows",
    f"""SELECT o_orderkey, CASE WHEN md5({_key_sql('o_orderkey')}) < '{_SPLIT_BOUND}' THEN 'test' ELSE 'training' END AS "set" FROM orders""",
)
def hash_split_rows(spark, sf_dir):
    training, test = sampling.hash_split(table(spark, sf_dir, "orders"), 0.2, "o_orderkey")
    marked = [part.select("o_orderkey", F.lit(name).alias("set")) for name, part in (("training", training), ("test", test))]
    return marked[0].unionByName(marked[1])


_BUCKET_SQL = f"CAST(CAST('0x' || substr(md5({_key_sql('o_orderkey')}), 1, 8) AS BIGINT) % 1000 AS INTEGER)"


@query(
    "disjoint_batches",
    f"SELECT *, {_BUCKET_SQL} AS batch FROM orders WHERE {_BUCKET_SQL} < 10",
)
def disjoint_batches(spark, sf_dir):
    return sampling.disjoint_batches(table(spark, sf_dir, "orders"), "o_orderkey", 10, 1000, spark)


@query("saved_and_reread", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def saved_and_reread(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return materialize(done, spark, label="saved")


@query("csv_round_trip", "SELECT * FROM orders")
def csv_round_trip(spark, sf_dir):
    """Orders as CSV with a header, its columns in another order, read back by name."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv")
    orders.select(*reversed(orders.columns)).write.option("header", "true").csv(path)
    return read_table(spark, path, "csv", TABLE_SCHEMAS["orders"])


@query("saved_table", "SELECT * FROM supplier")
def saved_table(spark, sf_dir):
    """A catalog table, written and read by name."""
    name = f"rideflow_supplier_{uuid.uuid4().hex[:12]}"
    save_table(table(spark, sf_dir, "supplier"), scratch_path(spark, "table"), name=name)
    return spark.table(name)


@query("rand_split_counts")
def rand_split_counts(spark, sf_dir):
    training, test = sampling.rand_split(table(spark, sf_dir, "orders"), 0.2, 42)
    return agg.row_count(training).select(F.lit("training").alias("set"), "n_rows").unionByName(
        agg.row_count(test).select(F.lit("test").alias("set"), "n_rows")
    )


@query("random_split_counts")
def random_split_counts(spark, sf_dir):
    training, test = sampling.random_split(table(spark, sf_dir, "orders"), 0.2, 42)
    return agg.row_count(training).select(F.lit("training").alias("set"), "n_rows").unionByName(
        agg.row_count(test).select(F.lit("test").alias("set"), "n_rows")
    )


# --- chart tables -----------------------------------------------------------


@query(
    "bar_chart",
    """WITH c AS (SELECT o_orderpriority AS category, count(*) AS "count" FROM orders GROUP BY o_orderpriority),
s AS (SELECT *, 100.0::DOUBLE * "count" / sum("count") OVER () AS "percent" FROM c)
SELECT category, "count", "percent",
       printf('%.0f%%', "percent") AS label, "percent" > 20 AS above_cutoff,
       category = '1-URGENT' AS highlight FROM s""",
)
def bar_chart(spark, sf_dir):
    return charts.bar_chart_data(table(spark, sf_dir, "orders"), "o_orderpriority", 20.0, "1-URGENT")


@query(
    "scatter_series",
    """SELECT p_size, p_retailprice, CASE WHEN coalesce(p_type = 'SMALL', false) THEN 'small'
       ELSE 'other' END AS series FROM part""",
)
def scatter_series(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return charts.scatter_series(part, "p_size", "p_retailprice", F.col("p_type") == "SMALL", ("small", "other"))


# --- machine learning -------------------------------------------------------

# The event model's features.
EVENT_FEATURES = ("month", "day_of_week", "day_of_month", "event_type_is_click", "hour", "k")


def _event_job(spark: SparkSession, sf_dir: str, learner: str) -> RideJob:
    t = load_tables(spark, sf_dir, ["events", "customer"])
    events = t["events"].withColumns(
        # An event without k gets a value of its own, so that no row is left out of the fit.
        {"hour": F.hour("ts"), "k": F.coalesce(F.get_json_object("props", "$.k").cast("double"), F.lit(-1.0))}
    )
    job = RideJob(
        RideConfig(
            prepare=EVENT_PREPARE,
            label="value",
            feature_cols=EVENT_FEATURES,
            learner=learner,
            split_keys=("event_id",),
            trips_name="events",
            zones_name="customer",
        ),
        spark,
    )
    job.tables.update({"events": events, "customer": t["customer"]})
    job.transform()
    job.train()
    job.validate()
    return job


@query("rf_metrics")
def rf_metrics(spark, sf_dir):
    return _event_job(spark, sf_dir, "rf").report["metrics"]


@query("gbt_metrics")
def gbt_metrics(spark, sf_dir):
    return _event_job(spark, sf_dir, "gbt").report["metrics"]


@query("importances")
def importances(spark, sf_dir):
    return _event_job(spark, sf_dir, "rf").report["importances"]


@query("saved_model_scores")
def saved_model_scores(spark, sf_dir):
    job = _event_job(spark, sf_dir, "rf")
    path = save_model(job.model, scratch_path(spark, "model"))
    return ml.score(PipelineModel.load(path), job.tables["test"]).select("event_id", "value", "prediction")


# The prepared rows of the event model, each in its part of the split.
_MODEL_ROWS = f"""WITH m AS (SELECT event_id, CASE WHEN md5({_key_sql("event_id")}) < '{_SPLIT_BOUND}'
  THEN 'test' ELSE 'training' END AS "set" FROM ({_prepared_sql(3, _ANTI_AUTO)}))"""


@query("reloaded_scores", _MODEL_ROWS + ' SELECT event_id, "set", true AS same FROM m')
def reloaded_scores(spark, sf_dir):
    """Every prepared row: whether the saved and reloaded model scores it as the one in memory does."""
    job = _event_job(spark, sf_dir, "rf")
    path = save_model(job.model, scratch_path(spark, "model"))
    both = job.parts()
    mine = ml.score(job.model, both).select("event_id", "set", F.col("prediction").alias("mine"))
    again = ml.score(PipelineModel.load(path), both).select(F.col("event_id").alias("id"), F.col("prediction").alias("again"))
    joined = mine.join(again, F.col("event_id") == F.col("id"))
    return joined.select("event_id", "set", (F.col("mine") == F.col("again")).alias("same"))


@query("model_metrics", _MODEL_ROWS + ' SELECT "set", count(*) AS n_rows, true AS same FROM m GROUP BY "set"')
def model_metrics(spark, sf_dir):
    """The report's metrics beside an independent aggregate of the same predictions."""
    job = _event_job(spark, sf_dir, "gbt")
    error = F.col("value") - F.col("prediction")
    other = ml.score(job.model, job.parts()).groupBy(F.col("set").alias("of")).agg(
        F.sqrt(F.avg(error * error)).alias("rmse2"), F.avg(F.abs(error)).alias("mae2")
    )
    close = (F.abs(F.col("rmse") - F.col("rmse2")) < 1e-9) & (F.abs(F.col("mae") - F.col("mae2")) < 1e-9)
    return job.report["metrics"].join(other, F.col("set") == F.col("of")).select("set", "n_rows", close.alias("same"))


@query(
    "importance_sum",
    " UNION ALL ".join(f"SELECT '{name}' AS feature, 1.0::DOUBLE AS total" for name in EVENT_FEATURES),
)
def importance_sum(spark, sf_dir):
    """Each feature once; the importances add up to one."""
    found = _event_job(spark, sf_dir, "rf").report["importances"]
    total = found.agg(F.round(F.sum("importance"), 9)).scalar()
    return found.select("feature", total.alias("total"))


@query("job_run", _MODEL_ROWS + ' SELECT "set", count(*) AS n_rows FROM m GROUP BY "set"')
def job_run(spark, sf_dir):
    """The whole job, from its sources to the saved model."""
    sources = {name: TableSpec(f"{sf_dir}/{name}.parquet", "parquet", TABLE_SCHEMAS[name]) for name in ("events", "customer")}
    config = RideConfig(
        prepare=EVENT_PREPARE, label="value", feature_cols=EVENT_FEATURES[:4], split_keys=("event_id",),
        trips_name="events", zones_name="customer",
    )
    job = RideJob(config, spark, sources)
    return job.run(model_path=scratch_path(spark, "model"))["metrics"].select("set", "n_rows")


@query(
    "metrics_from_predictions",
    """WITH m AS (SELECT event_type, avg(value) AS prediction FROM events GROUP BY event_type),
p AS (SELECT e.value AS y, m.prediction AS yhat FROM events e JOIN m ON e.event_type = m.event_type),
a AS (SELECT count(*) AS n, sum((y - yhat) * (y - yhat)) AS sse, sum(abs(y - yhat)) AS sae,
             var_pop(y) AS var_y FROM p)
SELECT round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae,
       round(1.0 - sse / (var_y * n), 6) AS r2, n AS n_rows FROM a""",
)
def metrics_from_predictions(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    means = ev.groupBy("event_type").agg(F.avg("value").alias("prediction"))
    scored = ev.join(means, "event_type")
    m = ml.regression_metrics(scored, "value")
    return m.select(*[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")], "n_rows")


# --- streaming --------------------------------------------------------------


@query(
    "stream_filtered_events",
    """SELECT * FROM events e WHERE strftime(ts, '%Y%m') > '202312' AND strftime(ts, '%Y%m') <= '202401'
       AND hour(ts) BETWEEN 17 AND 23 AND NOT EXISTS
       (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND lower(c.c_mktsegment) LIKE '%auto%')""",
)
def stream_filtered_events(spark, sf_dir):
    # As a glob, which is what a file stream reads besides folders.
    events = file_stream(spark, f"{sf_dir}/events.parque[t]", TABLE_SCHEMAS["events"])
    return stream_filtered(events, table(spark, sf_dir, "customer"), EVENT_PREPARE)


@query(
    "stream_first_events",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS nth
       FROM (SELECT DISTINCT * FROM events WHERE ts IS NOT NULL)) WHERE nth <= 3
       AND ts < (SELECT date_trunc('day', max(ts) - INTERVAL 1 HOUR) FROM events)""",
)
def stream_first_events(spark, sf_dir):
    # The days that the watermark has closed; the last day stays in the state.
    events = file_stream(spark, f"{sf_dir}/events.parque[t]", TABLE_SCHEMAS["events"])
    return stream_first_n(events, "user_id", "ts", 3, tie="event_id")


def _utc(fn: Query) -> Query:
    """Run ``fn`` with the session zone pinned to UTC, as the library assumes."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# --- along the time axis: as-of and interval joins, frames, sessions, quantiles ------


@query(
    "as_of_clicks",
    """SELECT p.event_id, p.user_id, p.ts, c.event_id AS click_id, c.ts AS click_ts
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""",
)
def as_of_clicks(spark, sf_dir):
    """The user's latest click at or before each purchase."""
    events = table(spark, sf_dir, "events")
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.filter("event_type = 'click'")
    return temporal.as_of_join(
        bought, clicks, ["user_id"], "ts", "ts", {"click_id": "event_id", "click_ts": "ts"}, right_order=["event_id"]
    )


@query(
    "as_of_order_price",
    """SELECT e.o_orderkey AS order_key, e.o_orderdate, p.o_orderkey AS big_key, p.o_totalprice AS big_price
       FROM orders e ASOF LEFT JOIN (
         SELECT o_orderpriority, o_orderdate, arg_max(o_totalprice, o_orderkey) AS o_totalprice, max(o_orderkey) AS o_orderkey
         FROM orders WHERE o_totalprice > 400000 GROUP BY o_orderpriority, o_orderdate) p
       ON e.o_orderpriority = p.o_orderpriority AND e.o_orderdate >= p.o_orderdate""",
)
def as_of_order_price(spark, sf_dir):
    """The latest large order of the same priority: five keys, each of a fifth of all rows."""
    orders = table(spark, sf_dir, "orders")
    every = orders.select(F.col("o_orderkey").alias("order_key"), "o_orderdate", "o_orderpriority")
    large = orders.filter("o_totalprice > 400000")
    joined = temporal.as_of_join(
        every,
        large,
        ["o_orderpriority"],
        "o_orderdate",
        "o_orderdate",
        {"big_key": "o_orderkey", "big_price": "o_totalprice"},
        right_order=["o_orderkey"],
    )
    return joined.drop("o_orderpriority")


@query(
    "events_after_errors",
    """SELECT e.event_id AS error_id, e.user_id, x.event_id, x.ts FROM events e JOIN events x
       ON x.user_id = e.user_id AND x.ts BETWEEN e.ts AND e.ts + INTERVAL 12 HOUR WHERE e.event_type = 'error'""",
)
def events_after_errors(spark, sf_dir):
    """What each user did in the twelve hours after an error: points in intervals."""
    events = table(spark, sf_dir, "events")
    errors = events.filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), F.col("user_id").alias("of_user"), F.col("ts").alias("since"), F.expr("ts + INTERVAL 12 HOURS").alias("until")
    )
    found = temporal.interval_join(errors, events, ("since", "until"), ("ts", "ts"), {"of_user": "user_id"})
    return found.select("error_id", "user_id", "event_id", "ts")


@query(
    "overlapping_orders",
    """WITH spans AS (SELECT o_orderkey, o_custkey, least(o_orderdate, min(l_shipdate)) AS since, greatest(o_orderdate, max(l_shipdate)) AS until
         FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate)
       SELECT a.o_orderkey AS first_key, b.o_orderkey AS second_key, a.o_custkey FROM spans a JOIN spans b
       ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.since <= b.until AND b.since <= a.until""",
)
def overlapping_orders(spark, sf_dir):
    """Pairs of a customer's orders of which one was open while the other was: intervals with intervals."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    shipped = lines.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    spans = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_custkey", F.least("o_orderdate", "first_ship").alias("since"), F.greatest("o_orderdate", "last_ship").alias("until")
    )
    spans = materialize(spans, label="order-spans")
    other = spans.withColumnsRenamed({c: f"other_{c}" for c in spans.columns})
    found = temporal.interval_join(spans, other, ("since", "until"), ("other_since", "other_until"), {"o_custkey": "other_o_custkey"})
    found = found.filter("o_orderkey < other_o_orderkey")
    return found.select(F.col("o_orderkey").alias("first_key"), F.col("other_o_orderkey").alias("second_key"), "o_custkey")


@query(
    "day_before_per_user",
    """SELECT event_id, user_id, ts, CAST(sum(CAST(value AS DECIMAL(12,2))) OVER w AS DECIMAL(22,2)) AS day_value, count(*) OVER w AS day_events, max(value) OVER w AS day_max
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)""",
)
def day_before_per_user(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    sums = {"day_value": F.sum(F.col("value").cast("decimal(12,2)")), "day_events": F.count(F.lit(1)), "day_max": F.max("value")}
    return temporal.frame_aggregates(events, sums, "user_id", "ts", temporal.DAY).drop("value")


@query(
    "week_before_per_flag",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) OVER w AS DECIMAL(22,2)) AS week_quantity, count(*) OVER w AS week_lines
       FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def week_before_per_flag(spark, sf_dir):
    """Three keys, each of a third of all rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_quantity")
    sums = {"week_quantity": F.sum(F.col("l_quantity").cast("decimal(12,2)")), "week_lines": F.count(F.lit(1))}
    return temporal.frame_aggregates(lines, sums, "l_returnflag", "l_shipdate", 6 * temporal.DAY).drop("l_quantity")


_SESSION_SQL = """WITH s AS (SELECT *, coalesce(CAST(ts - lag(ts) OVER w > INTERVAL 6 HOUR AS BIGINT), 1) AS opens
  FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
numbered AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY {key} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM s)"""


@query(
    "user_sessions",
    _SESSION_SQL.format(key="user_id")
    + " SELECT user_id, session, min(ts) AS start, max(ts) AS \"end\", count(*) AS n FROM numbered GROUP BY user_id, session",
)
def user_sessions(spark, sf_dir):
    return temporal.session_lengths(table(spark, sf_dir, "events"), "user_id", "ts", 6 * temporal.HOUR)


@query(
    "session_of_event",
    _SESSION_SQL.format(key="event_type").replace("6 HOUR", "20 MINUTE") + " SELECT event_id, event_type, session FROM numbered",
)
def session_of_event(spark, sf_dir):
    """Five keys, each of a fifth of all rows."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return temporal.sessions(events, "event_type", "ts", temporal.HOUR // 3, order=["event_id"]).drop("ts")


@query(
    "price_quantiles",
    """SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median_price, quantile_disc(l_extendedprice, 0.99) AS high_price
       FROM lineitem GROUP BY l_returnflag""",
)
def price_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quantiles.exact_quantiles(lines, "l_returnflag", "l_extendedprice", {"median_price": 0.5, "high_price": 0.99})


@query(
    "ship_date_quantiles",
    """SELECT l_suppkey, quantile_disc(l_shipdate, 0.25) AS early, quantile_disc(l_shipdate, 0.75) AS late
       FROM lineitem GROUP BY l_suppkey""",
)
def ship_date_quantiles(spark, sf_dir):
    return quantiles.exact_quantiles(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_shipdate", {"early": 0.25, "late": 0.75})


# --- tables as multisets, lattices of groups, samples of exact size --------------------

_LINES_OF = "SELECT l_suppkey, l_quantity, l_tax FROM lineitem WHERE l_returnflag = '{}'"


def _lines_of(spark, sf_dir, flag):
    return table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag).select("l_suppkey", "l_quantity", "l_tax")


@query("lines_except_all", f"{_LINES_OF.format('A')} EXCEPT ALL {_LINES_OF.format('R')}")
def lines_except_all(spark, sf_dir):
    return multisets.except_all(_lines_of(spark, sf_dir, "A"), _lines_of(spark, sf_dir, "R"))


@query("lines_intersect_all", f"{_LINES_OF.format('A')} INTERSECT ALL {_LINES_OF.format('R')}")
def lines_intersect_all(spark, sf_dir):
    return multisets.intersect_all(_lines_of(spark, sf_dir, "A"), _lines_of(spark, sf_dir, "R"))


@query(
    "order_changes",
    """WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 1),
       a AS (SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
             FROM orders WHERE o_orderkey % 10 <> 2)
       SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
         CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN a.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
         CAST(b.o_orderkey IS NOT NULL AS BIGINT) AS n_removed, CAST(a.o_orderkey IS NOT NULL AS BIGINT) AS n_added
       FROM b FULL JOIN a ON a.o_orderkey = b.o_orderkey
       WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""",
)
def order_changes(spark, sf_dir):
    """What differs between two states of the orders, by key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    status = F.when(F.col("o_totalprice") > 300000, "X").otherwise(F.col("o_orderstatus"))
    after = orders.filter("o_orderkey % 10 <> 2").withColumn("o_orderstatus", status)
    return multisets.table_changes(orders.filter("o_orderkey % 10 <> 1"), after, "o_orderkey")


@query(
    "flag_cube",
    """SELECT l_returnflag, l_linestatus, l_linenumber, CAST(grouping(l_returnflag, l_linestatus, l_linenumber) AS INTEGER) AS grouping,
       count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS quantity, count(DISTINCT l_suppkey) AS suppliers
       FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
)
def flag_cube(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    dims = ["l_returnflag", "l_linestatus", "l_linenumber"]
    sums = {"quantity": F.col("l_quantity").cast("decimal(12,2)")}
    return multisets.grouping_lattice(lines, dims, sums, "l_suppkey", distinct_out="suppliers")


@query(
    "order_rollup",
    """SELECT o_orderpriority, o_orderstatus, CAST(grouping(o_orderpriority, o_orderstatus) AS INTEGER) AS grouping,
       count(*) AS n, count(DISTINCT o_custkey) AS customers
       FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""",
)
def order_rollup(spark, sf_dir):
    dims = ["o_orderpriority", "o_orderstatus"]
    return multisets.grouping_lattice(
        table(spark, sf_dir, "orders"), dims, {}, "o_custkey", sets=[dims, dims[:1], []], distinct_out="customers"
    )


@query(
    "sample_per_priority",
    """SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
       ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS nth FROM orders) WHERE nth <= 25""",
)
def sample_per_priority(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_sample(orders, "o_orderpriority", 25, "o_orderkey")


@query(
    "weighted_sample_per_status",
    """SELECT o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY
       -ln((CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / o_totalprice) AS nth
       FROM orders WHERE o_totalprice > 0) WHERE nth <= 40""",
)
def weighted_sample_per_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sampling.stratified_sample(orders, "o_orderstatus", 40, "o_orderkey", "o_totalprice").drop("o_totalprice")


@query(
    "sketched_years",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, TRUE AS distinct_near, TRUE AS median_near
       FROM lineitem GROUP BY 1""",
)
def sketched_years(spark, sf_dir):
    # States per month, stored, then merged per year; held against the exact count and the median's rank.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    )
    months = materialize(sketches.sketch_states(lines, ["year", "month"], "l_orderkey", "l_extendedprice"), label="months")
    years = materialize(sketches.read_states(sketches.merge_states(months, ["year"]), {"median": 0.5}), label="years")
    below = (F.col("l_extendedprice").cast("double") <= F.col("median")).cast("int")
    exact = lines.join(years.select("year", "median"), "year").groupBy("year").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.avg(below).alias("share")
    )
    near = F.abs(F.col("n_distinct") - F.col("orders")) <= 0.03 * F.col("orders")
    return years.join(exact, "year").select(
        "year", "n", near.alias("distinct_near"), (F.abs(F.col("share") - 0.5) <= 0.02).alias("median_near")
    )


def queries() -> dict[str, Query]:
    return {name: _utc(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)

