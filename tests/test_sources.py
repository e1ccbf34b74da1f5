import pytest
from pyspark.sql import types as T

from rideflow.session import checkpoint_root, scratch_path
from rideflow.sources import TableSpec, ZONE_SCHEMA, extract, materialize, read_table, save_table


def test_csv_needs_a_schema_and_fails_fast(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("zone_id,zone_name,borough\n1,Newark Airport,EWR\n2,Jamaica Bay,Queens\n")
    got = read_table(spark, str(path), "csv", ZONE_SCHEMA)
    assert got.schema == ZONE_SCHEMA
    assert [r.zone_name for r in got.orderBy("zone_id").collect()] == ["Newark Airport", "Jamaica Bay"]
    with pytest.raises(ValueError):
        read_table(spark, str(path), "csv")
    bad = T.StructType([T.StructField("zone_id", T.IntegerType()), T.StructField("zone_name", T.IntegerType()),
                        T.StructField("borough", T.StringType())])
    with pytest.raises(Exception):
        read_table(spark, str(path), "csv", bad).collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("zone_name,extra,zone_id,borough\n7,x,9,Queens\n")
    got = read_table(spark, str(path), "csv", ZONE_SCHEMA)
    assert got.schema == ZONE_SCHEMA and [tuple(r) for r in got.collect()] == [(9, "7", "Queens")]
    renamed = tmp_path / "renamed.csv"
    renamed.write_text("zone_id,zonename,borough\n1,a,b\n")
    with pytest.raises(ValueError, match="zone_name"):
        read_table(spark, str(renamed), "csv", ZONE_SCHEMA)
    bare = tmp_path / "bare.csv"
    bare.write_text("1,a,b\n")
    assert [tuple(r) for r in read_table(spark, str(bare), "csv", ZONE_SCHEMA, header=False).collect()] == [(1, "a", "b")]


def test_parquet_mismatch_raises(spark, tmp_path):
    path = str(tmp_path / "z")
    spark.createDataFrame([(1, "a", "b")], "zone_id int, zonename string, borough string").write.parquet(path)
    with pytest.raises(ValueError, match="zone_name"):
        read_table(spark, path, "parquet", ZONE_SCHEMA)
    typed = str(tmp_path / "t")
    spark.createDataFrame([("1", "a", "b")], "zone_id string, zone_name string, borough string").write.parquet(typed)
    with pytest.raises(ValueError, match="other types"):
        read_table(spark, typed, "parquet", ZONE_SCHEMA)


def test_extract_save_and_materialize(spark, tmp_path):
    csv = tmp_path / "z.csv"
    csv.write_text("zone_id,zone_name,borough\n1,a,b\n")
    frames = extract(spark, {"taxi_zone_geo": TableSpec(str(csv), "csv", ZONE_SCHEMA)})
    out = scratch_path(spark, "save-test")
    save_table(frames["taxi_zone_geo"], out, partition_by=["borough"])
    assert read_table(spark, out).count() == 1
    again = materialize(frames["taxi_zone_geo"], spark, label="m")
    assert again.collect() == frames["taxi_zone_geo"].collect()
    root = checkpoint_root(spark).replace("file://", "").replace("file:", "")
    assert root in again.inputFiles()[0]


def test_save_as_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    save_table(df, str(tmp_path / "t"), name="rideflow_saved")
    assert spark.table("rideflow_saved").count() == 1
    save_table(df.union(df), str(tmp_path / "t"), name="rideflow_saved")
    assert spark.table("rideflow_saved").count() == 2


def test_materialize_gives_the_disk_of_shuffles_back(spark):
    import glob
    import tempfile
    import time

    from rideflow.sources import materialize

    root = spark.conf.get("spark.local.dir", tempfile.gettempdir())
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def shuffles():
        return set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data"))

    before, was = shuffles(), spark.conf.get(setting, None)
    kept = materialize(spark.range(1000).repartition(4, "id"), label="test")
    end = time.time() + 10
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and kept.count() == 1000
    assert spark.conf.get(setting, None) == was
