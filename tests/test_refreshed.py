import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import trips
from tidelake.plans.lake import Lake
from tidelake.sources import refreshed


def ids(df):
    return sorted(r.id for r in df.collect())


def dying(spark, rows=100):
    return spark.range(rows).select(F.when(F.col("id") < rows - 1, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="killed"):
        refreshed.replace(dying(spark), path)
    assert not refreshed.exists(spark, path) and refreshed.read(spark, path, spark.range(1).schema).collect() == []
    with pytest.raises(FileNotFoundError):
        refreshed.read(spark, path)
    refreshed.replace(spark.range(3), path)
    with pytest.raises(Exception, match="killed"):
        refreshed.replace(dying(spark), path)
    assert ids(refreshed.read(spark, path)) == [0, 1, 2]
    refreshed.replace(spark.range(5), path)
    assert ids(refreshed.read(spark, path)) == [0, 1, 2, 3, 4]


def test_a_refresh_that_is_killed_while_it_writes(spark, tmp_path):
    """The job is cancelled after some of its files are there; readers before, during and after see the old rows."""
    path = str(tmp_path / "t")
    refreshed.replace(spark.range(4), path)

    @F.udf("long")
    def slow(i):
        time.sleep(0.0 if i < 50 else 60)
        return i

    failed = []

    def run():
        spark.sparkContext.setJobGroup("killed-refresh", "to be killed", interruptOnCancel=True)
        try:
            refreshed.replace(spark.range(0, 100, 1, 8).select(slow("id").alias("id")), path)
        except Exception as error:
            failed.append(error)

    thread = threading.Thread(target=run)
    thread.start()
    until = time.time() + 60
    while time.time() < until and not list(Path(path).glob("refresh=000000000002-*/_temporary/**/*.parquet")):
        time.sleep(0.2)
    assert ids(refreshed.read(spark, path)) == [0, 1, 2, 3]
    while thread.is_alive():
        spark.sparkContext.cancelJobGroup("killed-refresh")
        thread.join(1)
    assert failed and ids(refreshed.read(spark, path)) == [0, 1, 2, 3]
    # What a dead driver leaves: files without the mark.
    half = Path(path) / "refresh=000000000009-00000000"
    spark.range(7).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert ids(refreshed.read(spark, path)) == [0, 1, 2, 3]
    refreshed.replace(spark.range(2), path)
    assert ids(refreshed.read(spark, path)) == [0, 1] and not half.exists()


def test_old_folders_go_and_open_reads_end(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        opened = refreshed.read(spark, path) if n > 1 else None
        refreshed.replace(spark.range(n), path)
        assert opened is None or opened.count() == n - 1  # the folder before stays for it
        assert len(list(Path(path).glob("refresh=*"))) <= 2
    refreshed.replace(refreshed.read(spark, path).filter("id > 0"), path)
    assert ids(refreshed.read(spark, path)) == [1, 2, 3, 4]


def test_a_view_follows_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS refreshed_ns")
    refreshed.replace(spark.range(2), path)
    refreshed.publish(spark, "refreshed_ns.t", path)
    assert spark.table("refreshed_ns.t").count() == 2
    refreshed.replace(spark.range(3).withColumn("more", F.lit("x")), path)
    refreshed.publish(spark, "refreshed_ns.t", path)
    assert spark.table("refreshed_ns.t").columns == ["id", "more"] and spark.table("refreshed_ns.t").count() == 3
    spark.sql("DROP VIEW refreshed_ns.t")
    spark.sql("DROP NAMESPACE refreshed_ns")


def test_a_failed_refresh_of_the_lake(spark, tmp_path, catalog, monkeypatch):
    from tidelake.plans import lake as lake_module

    for name, df in zip(("paradas.csv", "estaciones.csv"), catalog, strict=True):
        df.coalesce(1).write.option("header", "true").csv(str(tmp_path / "catalog" / name))
    (tmp_path / "trips.csv").write_text(trips(40, 1, "trips.csv"), encoding="utf-8")
    lake = Lake(spark, str(tmp_path / "lake"), str(tmp_path / "catalog"), namespace="refreshed_lake")
    spark.sql("CREATE NAMESPACE IF NOT EXISTS refreshed_lake")
    lake.ingest(str(tmp_path / "trips.csv"))
    lake.refresh_silver()
    counts = lake.refresh_gold()
    before = {name: lake.gold(name).count() for name in counts}
    assert before == counts and spark.table("refreshed_lake.silver_trips").count() == lake.silver().count() > 0
    real = lake_module.gold.line_month_delay
    monkeypatch.setattr(lake_module.gold, "line_month_delay", lambda *a, **k: real(*a, **k).withColumn("line", F.raise_error(F.lit("killed")).cast("string")))
    with pytest.raises(Exception, match="killed"):
        lake.refresh_gold()
    assert {name: lake.gold(name).count() for name in counts} == before
    for name in ("silver_trips", *(f"gold_{n}" for n in counts)):
        spark.sql(f"DROP VIEW refreshed_lake.{name}")
    spark.sql("DROP NAMESPACE refreshed_lake")
