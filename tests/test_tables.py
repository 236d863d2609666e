import pytest
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.plans import bronze
from tidelake.sources import files, loads, namespaces, tables
from tests.test_jobs import trips


def test_a_batch_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.put_batch(spark.range(5), path, "a/1.csv")
    tables.put_batch(spark.range(7), path, "b/1.csv")
    tables.put_batch(spark.range(6), path, "a/1.csv")
    rows = tables.read(spark, path)
    assert {r.batch: r["count"] for r in rows.groupBy("batch").count().collect()} == {"a/1.csv": 6, "b/1.csv": 7}
    assert tables.has_batch(spark, path, "a/1.csv") and not tables.has_batch(spark, path, "a/2.csv")
    assert not tables.has_batch(spark, str(tmp_path / "none"), "x")
    with pytest.raises(ValueError):
        tables.put_batch(spark.range(1), path, "")


def test_empty_text_is_not_null(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.put_batch(spark.createDataFrame([("",), (None,), ("x",)], "line string"), path, "k")
    assert sorted(str(r.line) for r in tables.read(spark, path).collect()) == ["", "None", "x"]


def test_a_write_that_died_leaves_no_rows_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.put_batch(spark.range(3), path, "old")
    dies = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))
    for key in ("new", "old"):
        with pytest.raises(Exception, match="killed"):
            tables.put_batch(dies, path, key)
    assert tables.read(spark, path, tables.batched(spark.range(1).schema)).count() == 3
    tables.put_batch(spark.range(4), path, "new")
    assert tables.read(spark, path).count() == 7
    first = str(tmp_path / "first")
    with pytest.raises(Exception, match="killed"):
        tables.put_batch(dies, first, "k")
    assert tables.read(spark, first, tables.batched(spark.range(1).schema)).count() == 0
    tables.put_batch(spark.range(2), first, "k")
    assert tables.read(spark, first).count() == 2


def test_absent_tables_are_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not tables.exists(spark, path)
    assert tables.read(spark, path, spark.range(1).schema).count() == 0
    assert not (tmp_path / "none").exists()


def test_equal_names_in_other_folders_are_other_batches(spark, tmp_path):
    table = str(tmp_path / "bronze")
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "trips.csv").write_text(trips(10, 1, folder), encoding="utf-8")
        assert bronze.ingest_trips(spark, table, str(tmp_path / folder / "trips.csv"), landing=str(tmp_path)) == f"{folder}/trips.csv"
    assert bronze.ingest_trips(spark, table, str(tmp_path / "a" / "trips.csv"), landing=str(tmp_path)) is None
    rows = bronze.read_bronze(spark, table)
    assert rows.count() == 20 and rows.columns == schemas.BRONZE_TRIPS.names


def test_added_columns_and_their_difference(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.put_batch(spark.range(2), path, "1")
    tables.put_batch(spark.range(3).withColumn("weather", F.lit("rain")), path, "2")
    rows = tables.read(spark, path, merge=True)
    assert rows.filter("weather is null").count() == 2
    diff = tables.schema_diff(spark.range(1), rows.drop("batch"))
    assert [(r.column, r.older, r.newer) for r in diff.collect()] == [("weather", None, "string")]


def test_namespaces(spark):
    namespaces.ensure_namespace(spark, "lake_ns")
    spark.range(3).write.mode("overwrite").saveAsTable("lake_ns.numbers")
    assert namespaces.table_exists(spark, "lake_ns.numbers")
    spark.range(1).createOrReplaceTempView("session_view")
    assert [r.tableName for r in namespaces.list_tables(spark, "lake_ns").collect()] == ["numbers"]
    spark.catalog.dropTempView("session_view")
    assert [r.col_name for r in namespaces.describe(spark, "lake_ns.numbers").collect()] == ["id"]
    namespaces.drop_table(spark, "lake_ns.numbers")
    assert not namespaces.table_exists(spark, "lake_ns.numbers")
    namespaces.drop_namespace(spark, "lake_ns")


def test_loads_are_numbered_by_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for key, at, rows in (("b", "2026-01-02", 3), ("a", "2026-01-01", 2), ("c", "2026-01-02", 4)):
        tables.put_batch(spark.range(rows).withColumn("at", F.lit(at).cast("timestamp")), path, key)
    table = tables.read(spark, path)
    got = [(r.snapshot_id, r.batch_key, r.added_records, r.total_records) for r in loads.history(table, "at").orderBy("snapshot_id").collect()]
    assert got == [(1, "a", 2, 2), (2, "b", 3, 5), (3, "c", 4, 9)]
    assert loads.as_of_load(table, 2, "at").count() == 5 and loads.as_of_time(table, "2026-01-01 12:00:00", "at").count() == 2
    assert tuple(loads.delta(table, 1, 3, "at").first()) == (2, 9, 7)
    # Loaded again: the batch moves behind the others, and its old rows are gone.
    tables.put_batch(spark.range(1).withColumn("at", F.lit("2026-01-03").cast("timestamp")), path, "a")
    assert [r.batch_key for r in loads.history(tables.read(spark, path), "at").orderBy("snapshot_id").collect()] == ["b", "c", "a"]
    assert tables.batch_keys(spark, path) == {"a", "b", "c"} and tables.batch_keys(spark, str(tmp_path / "none")) == set()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    wanted = schemas.struct("station_id string, nombre string, latitud double")
    path = tmp_path / "stations.csv"
    path.write_text("nombre,extra,latitud,station_id\nNiquía,x,6.5,S1\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(path), wanted).collect()] == [("S1", "Niquía", 6.5)]
    path.write_text("nombre,station_id\nNiquía,S1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="latitud"):
        files.read_csv(spark, str(path), wanted)
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("station_id,nombre,latitud\nS1,N,1\n", encoding="utf-8")
    (folder / "b.csv").write_text("nombre,station_id,latitud\nN,S1,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(folder), wanted).collect()
