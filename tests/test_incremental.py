import pytest
from pyspark.sql import functions as F

from tests.test_jobs import STATIONS, STOPS, trips
from tidelake.operators import sizing
from tidelake.operators.inspect import plan_summary
from tidelake.plans import incremental
from tidelake.plans.lake import GOLD, Lake


def content(df):
    stamps = [c for c in df.columns if c.endswith("_ts")]
    return sorted(map(str, (tuple(r) for r in df.drop(*stamps).collect())))


@pytest.fixture
def lake(spark, tmp_path):
    (tmp_path / "catalog").mkdir()
    (tmp_path / "catalog" / "paradas.csv").write_text(STOPS, encoding="utf-8")
    (tmp_path / "catalog" / "estaciones.csv").write_text(STATIONS, encoding="utf-8")
    return Lake(spark, str(tmp_path / "lake"), str(tmp_path / "catalog"))


def load(lake, tmp_path, n, seed=None):
    path = tmp_path / f"batch_{n}.csv"
    path.write_text(trips(80, seed or n, path.name), encoding="utf-8")
    return lake.ingest(str(path), landing=str(tmp_path))


def test_states_give_the_tables_of_a_full_refresh(lake, tmp_path):
    assert lake.merged_gold("demanda_rutas").collect() == []
    for n in (2, 1, 3):
        key = load(lake, tmp_path, n)
        assert lake.update_gold() == [key] and lake.update_gold() == []
    lake.refresh_silver()
    lake.refresh_gold()
    for name in GOLD:
        assert content(lake.merged_gold(name)) == content(lake.gold(name)) != []
        assert lake.merged_gold(name).columns == lake.gold(name).columns


def test_only_the_new_batch_is_read(lake, tmp_path, spark):
    for n in (1, 2, 3):
        load(lake, tmp_path, n)
    lake.update_gold()
    rows = incremental.one_batch(spark, lake.path("silver_batches"), "batch_3.csv")
    plan = plan_summary(incremental.TABLES["demanda_rutas"].of_batch(rows))
    assert any("batch" in f and "batch_3.csv" in f for f in plan["partition_filters"])
    assert "trip_id" not in plan["read_schema"][0]
    read = rows.select(F.input_file_name()).distinct().collect()
    assert read and all("batch=batch_3.csv" in r[0] for r in read)


def test_a_batch_loaded_again_replaces_what_it_gave(lake, tmp_path, spark):
    from tidelake.plans import bronze
    from tidelake.sources import tables
    from tidelake.sources.files import read_trips

    for n in (1, 2):
        load(lake, tmp_path, n)
    lake.update_gold()
    before = content(lake.merged_gold("estaciones_volumen"))
    (tmp_path / "new.csv").write_text(trips(80, 9, "batch_1.csv"), encoding="utf-8")
    tables.put_batch(bronze.to_bronze(read_trips(spark, str(tmp_path / "new.csv"))), lake.path("bronze"), "batch_1.csv")
    assert lake.update_gold("batch_1.csv") == ["batch_1.csv"]
    lake.refresh_silver()
    lake.refresh_gold()
    assert before != content(lake.merged_gold("estaciones_volumen")) == content(lake.gold("estaciones_volumen"))


def test_sketches_stay_within_their_error(spark):
    """Thresholds by rank and distinct counts of 200 000 values from 20 batches, against the exact ones."""
    rows = spark.range(200_000).select(
        F.lit("A").alias("line"), (F.pmod(F.xxhash64("id"), F.lit(50_000))).cast("int").alias("passenger_count"),
        F.concat(F.lit("P"), F.pmod("id", F.lit(30_000))).alias("stop_id_origen"), F.col("id").cast("string").alias("trip_id"), (F.col("id") % 20).alias("part"),
    )
    kept = incremental.TABLES["lineas_aproximado"]
    states = [kept.of_batch(rows.filter(F.col("part") == k)) for k in range(20)]
    united = states[0]
    for more in states[1:]:
        united = united.unionByName(more)
    got = kept.merged(united, None).first()
    share = rows.filter(F.col("passenger_count") <= got.p90_about).count() / 200_000
    assert abs(share - 0.9) < 0.0265 and got.trips == 200_000
    assert abs(got.origins_about / 30_000 - 1) < 0.03 and abs(got.trip_ids_about / 200_000 - 1) < 0.03


def test_a_stop_that_comes_twice_fails_the_refresh(lake, tmp_path):
    load(lake, tmp_path, 1)
    (tmp_path / "catalog" / "paradas.csv").write_text(STOPS + "A1,S2,A,3,metro\n", encoding="utf-8")
    for job in (lake.refresh_silver, lake.update_gold):
        with pytest.raises(sizing.RepeatedKeyError, match="stop_id.*'A1'"):
            job()


def test_measured_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, v int")
    assert sizing.held_bytes(rows, "k") == sizing.held_bytes(rows)
    with pytest.raises(sizing.RepeatedKeyError, match="1 values of k"):
        sizing.held_bytes(rows.unionByName(rows.filter("k = 'b'")), "k")
    assert sizing.held_bytes(rows.limit(0), "k") == 0
