import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.operators import dimensions
from tidelake.operators.rules import reject_reason
from tidelake.plans import silver
from tidelake.sources import refreshed

DAY = dt.date(2024, 1, 1)
NOW = dt.datetime(2024, 1, 2)


def trip(trip_id="T", origin="A1", dest="A2", line="A", pax=10, delay=10, block="06-09"):
    return (trip_id, origin, dest, line, pax, delay, DAY, block, False, "f.csv", NOW, NOW)


BAD = [
    trip("good"), trip("good"),  # a repeated id is not an error
    trip(None), trip(origin=None), trip(dest=None), trip(line=None),
    trip("p0", pax=0), trip("p1", pax=1), trip("p400", pax=400), trip("p401", pax=401), trip("pnull", pax=None),
    trip("d-1", delay=-1), trip("d0", delay=0), trip("d1200", delay=1200), trip("d1201", delay=1201), trip("dnull", delay=None),
    trip("circ", dest="A1"),
    trip("oo", origin="X"), trip("od", dest="X"), trip("both", origin="X", dest="Y"),
    trip("block", block="23-24"), trip("transfer", origin="K1", dest="K2", line="K"),
]


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame(BAD, schemas.BRONZE_TRIPS)


@pytest.fixture(scope="module")
def dim(catalog):
    return dimensions.build_stop_dim(*catalog)


def test_rows_kept(bad, dim):
    kept = silver.build_silver(bad, dim)
    assert kept.columns == schemas.SILVER_COLUMNS and len(kept.columns) == 34
    ids = sorted(r.trip_id for r in kept.collect())
    assert ids == sorted(["good", "good", "p1", "p400", "d0", "d1200", "block", "transfer"])


def test_derived_columns(bad, dim):
    rows = {r.trip_id: r for r in silver.build_silver(bad, dim).collect()}
    good, ride = rows["good"], rows["transfer"]
    assert (good.n_stops, good.trip_direction, good.time_of_day, good.is_peak_hour) == (1, "forward", "mañana", True)
    assert (good.nombre_origen, good.municipio_destino, good.is_transfer_trip) == ("Niquía", "Envigado", True)
    assert (ride.tipo_servicio, ride.station_id_origen, ride.is_transfer_trip) == ("cable", "S2", True)
    assert rows["block"].time_of_day == "desconocido"


def test_accounting_is_complete(bad, dim):
    rows = {r.reason: r for r in silver.discard_accounting(bad, dim).collect()}
    counts = {k: r.discarded for k, r in rows.items()}
    assert counts == {
        "null_key": 4, "passenger_range": 2, "delay_range": 2, "null_measure": 2, "circular": 1,
        "orphan_origin": 2, "orphan_dest": 2, "_read": 22, "_kept": 8, "_discarded": 14,
    }
    assert {k for k, r in rows.items() if r.upstream_alert} == {"circular", "orphan_origin", "orphan_dest"}


def test_first_reason_wins(spark):
    rows = spark.createDataFrame([trip(None, pax=0), trip("a", pax=None, delay=-1)], schemas.BRONZE_TRIPS)
    got = rows.select(reject_reason(silver.trip_rules()).alias("r")).collect()
    assert [r.r for r in got] == ["null_key", "null_measure"]


def test_refresh_counts_on_the_way(spark, bad, dim, tmp_path):
    path = str(tmp_path / "silver")
    silver.refresh_silver(path, bad, dim)
    second = silver.refresh_silver(path, bad, dim)
    assert second["null_key"] == 4 and second["orphan_origin"] == 2 and second["_read"] == 22
    assert refreshed.read(spark, path).count() == 8


def test_enrich_same_without_broadcast(spark, bad, dim, monkeypatch):
    few = silver.build_silver(bad, dim).drop("silver_ingestion_ts")
    monkeypatch.setattr(dimensions, "is_small", lambda df, **more: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = silver.build_silver(bad, dim).drop("silver_ingestion_ts")
        assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _judged(monkeypatch, **answers):
    """``is_small`` by the key that it is asked about; ``places`` has none."""
    monkeypatch.setattr(dimensions, "is_small", lambda df, key=None: answers[(key or "places").lstrip("_")])


@pytest.mark.parametrize("answers", [
    {"stop_id": False, "kind": True, "places": True}, {"stop_id": False, "kind": True, "places": False}, {"stop_id": False, "kind": False},
])
def test_a_large_catalog_gives_the_same_rows(spark, bad, dim, monkeypatch, answers):
    """Stops without some attributes, and trips without ends, included."""
    odd = dim.unionByName(dim.filter("stop_id = 'A1'").withColumns({"stop_id": F.lit("X"), "nombre": F.lit(None).cast("string")}))
    few = dimensions.enrich_trips(bad, odd)
    _judged(monkeypatch, **answers)
    with_setting = dimensions.enrich_trips(bad, odd)
    assert with_setting.columns == few.columns
    assert with_setting.exceptAll(few).isEmpty() and few.exceptAll(with_setting).isEmpty() and few.count() == len(BAD)


def test_trips_are_not_shuffled_where_stops_and_attributes_are_small(spark, bad, dim, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _judged(monkeypatch, stop_id=False, kind=True, places=True)
        plan = dimensions.enrich_trips(bad, dim)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") == 4
        _judged(monkeypatch, stop_id=False, kind=True, places=False)
        plan = dimensions.enrich_trips(bad, dim)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("strategy=broadcast") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_trips_without_a_stop_do_not_meet_in_one_task(spark, dim, monkeypatch):
    one = spark.createDataFrame([trip(dest=None)], schemas.BRONZE_TRIPS).withColumn("stop_id_destino", F.lit(None).cast("string"))
    many = spark.range(4000).crossJoin(one).withColumn("trip_id", F.col("id").cast("string")).drop("id")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        _judged(monkeypatch, stop_id=False, kind=True, places=False)
        tasks = dimensions.enrich_trips(many, dim).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in tasks) == 4000 and max(r["count"] for r in tasks) < 1000


def test_catalog_lookups(catalog, spark):
    stops, stations = catalog
    lines = {r.station_id: r.lines for r in dimensions.lines_per_station(stops).collect()}
    assert lines["S2"] == ["A", "K"]
    assert {r.stop_id for r in dimensions.terminal_stops(stops).collect()} == {"A1", "A3", "K1", "K2"}
    assert [r.station_id for r in dimensions.transfer_stations(stations).collect()] == ["S2"]
    lonely = spark.createDataFrame([("Z", "S9")], "stop_id string, station_id string")
    assert dimensions.orphans(lonely, stations, "station_id").count() == 1


def test_sample_is_stable(bad):
    a = dimensions.sample_rows(bad, 3, F.desc("trip_id")).collect()
    assert [r.trip_id for r in a] == ["transfer", "pnull", "p401"]
