from pyspark.sql import functions as F

from rideflow.functions.columns import name_contains
from rideflow.operators import joins, nested


def test_chain_pair_count_equals_brute_force(spark):
    rides = spark.createDataFrame(
        [(1, 2), (2, 3), (2, 1), (3, 2), (2, 2), (None, 2), (4, None)], "pu int, do int"
    )
    brute = rides.alias("a").join(rides.alias("b"), F.col("a.do") == F.col("b.pu")).count()
    got = joins.chain_pair_count(rides, "do", rides, "pu").collect()[0].n_pairs
    assert got == brute == 14


def test_pair_counts_beyond_64_bits(spark):
    # Four billion rows of one key on each side, as counts.
    counts = spark.createDataFrame([(4_000_000_000, 4_000_000_000)], "n_left long, n_right long")
    got = counts.select(joins._pairs("n_left", "n_right").alias("n")).agg(F.sum("n").alias("n")).first().n
    assert got == 16 * 10**18


def test_batch_pair_counts_equal_brute_force(spark):
    rides = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (1, 2, 1), (1, 2, 2), (3, None, 2), (3, 4, None)], "batch int, pu int, do int")
    got = {r.batch: r.n_pairs for r in joins.batch_pair_counts(rides, "batch", "do", rides, "pu", 4).collect()}
    rows = rides.collect()
    want = {b: sum(1 for x in rows for y in rows if x.batch == b and x.do is not None and x.do == y.pu) for b in range(4)}
    assert got == want and want[2] == 0


def test_chain_pair_count_empty(spark):
    empty = spark.createDataFrame([], "pu int, do int")
    assert joins.chain_pair_count(empty, "do", empty, "pu").collect()[0].n_pairs == 0


def test_exclusion_modes(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "loc int")
    dim = spark.createDataFrame(
        [(1, "Newark Airport"), (2, "Midtown"), (2, "JFK Airport"), (5, "x")], "zone_id int, zone_name string"
    )
    pred = name_contains("zone_name", "AIRPORT")
    anti = sorted((r.loc is None, r.loc) for r in joins.exclude_by_dim(facts, "loc", dim, "zone_id", pred).collect())
    assert anti == [(False, 3), (True, None)]
    matched = joins.exclude_by_dim(facts, "loc", dim, "zone_id", pred, mode="matched_only")
    assert [r.loc for r in matched.collect()] == [2]


def test_label_and_enrich(spark):
    facts = spark.createDataFrame([(1,), (9,)], "zone_id int")
    dim = spark.createDataFrame([(1, "A", "Q")], "zone_id int, zone_name string, borough string")
    labelled = joins.label_dim(facts.withColumnRenamed("zone_id", "pickup_location_id"), dim,
                               "pickup_location_id", "zone_id", "pickup_")
    assert labelled.columns == ["pickup_location_id", "pickup_zone_name", "pickup_borough"]
    assert labelled.count() == 1
    enriched = {r.zone_id: r.zone_name for r in joins.enrich_left(facts, dim, "zone_id").collect()}
    assert enriched == {1: "A", 9: None}


def test_pack_nested_and_unpack(spark):
    df = spark.createDataFrame([(1, 10.0, 0.5, 2.0, 12.5)], "id int, fare double, tax double, tip double, total double")
    s = nested.pack(df, ["fare", "tax", "tip"], "contributions")
    s = nested.pack(s, ["contributions", "total"], "payments")
    assert s.columns == ["id", "payments"]
    flat = nested.unpack_field(s, "payments.contributions.tip", "tip")
    assert flat.collect()[0].tip == 2.0
    exploded = nested.explode_rows(s.select("id", F.array("payments", "payments").alias("arr")), "arr")
    assert exploded.count() == 2
    allf = nested.unpack_all(exploded, "arr.contributions")
    assert {"fare", "tax", "tip"} <= set(allf.columns)
    tips = s.select(F.array("payments").alias("ps")).select(
        nested.array_field(F.col("ps.contributions"), "tip").alias("tips")
    )
    assert tips.collect()[0].tips == [2.0]


def test_nth_element_short_array(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "a array<double>")
    assert [r.x for r in df.select(nested.nth_element("a", 2).alias("x")).collect()] == [None, 3.0]
