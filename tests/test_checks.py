import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.operators import checks
from tidelake.operators.inspect import plan_summary
from tidelake.operators.retention import fresh, retain
from tidelake.sources.files import read_csv, read_stations, read_stops

STOPS = """stop_id,station_id,linea,orden,tipo_servicio
A1,S1,A,1,metro
A2,S2,A,2,metro
B1,S1,B,1,metro
B3,S9,B,3,metro
K1,S2,K,1,cable
K1b,S2,K,1,cable
"""
STATIONS = """station_id,nombre,latitud,longitud,municipio,es_transbordo
S1,Niquía,6.33,-75.54,Bello,false
S2,Itagüí,6.16,-75.60,Itagüí,true
S3,Sola,6.16,-75.60,Envigado,false
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "stops.csv").write_text(STOPS, encoding="utf-8")
    (tmp_path / "stations.csv").write_text(STATIONS, encoding="utf-8")
    return str(tmp_path / "stops.csv"), str(tmp_path / "stations.csv")


def statuses(df):
    return {r.check: r.status for r in df.collect()}


def test_catalog_report(spark, files):
    stops, stations = read_csv(spark, files[0]), read_csv(spark, files[1])
    results = checks.report(
        [
            checks.check_types(stations, {"latitud": ("double",), "es_transbordo": ("boolean",), "nombre": ("int",)}, "st"),
            checks.check_count(stations, 3, "st:count"),
            checks.check_count(stops, 57, "stops:count"),
            checks.check_count(stations.filter("es_transbordo"), 1, "st:transfer"),
            checks.check_fk(stops, stations, "station_id", "stops:fk"),
            checks.check_fk(stations, stops, "station_id", "st:fk"),
            checks.check_values(stations, "nombre", ["Niquía", "Itagüí", "Acevedo"], "st:nombre"),
            checks.check_nonempty({"stops": stops, "none": stops.limit(0)}),
        ]
    )
    assert statuses(results) == {
        "st:latitud": "OK", "st:es_transbordo": "OK", "st:nombre": "FAIL", "st:count": "OK", "stops:count": "FAIL",
        "st:transfer": "OK", "stops:fk": "FAIL", "st:fk": "FAIL", "st:nombre:Niquía": "OK", "st:nombre:Itagüí": "OK",
        "st:nombre:Acevedo": "FAIL", "nonempty:stops": "OK", "nonempty:none": "FAIL",
    }
    assert tuple(checks.report_totals(results).first()) == (7, 6)


def test_declared_schemas(spark, files):
    assert read_stops(spark, files[0]).schema["orden"].dataType.simpleString() == "int"
    assert read_stations(spark, files[1]).filter("es_transbordo").count() == 1


def test_sequences(spark, files):
    stops = read_stops(spark, files[0])
    got = {r.linea: r.problem for r in checks.check_sequence(stops, "linea", "orden").collect()}
    assert got == {"A": "none", "B": "gap", "K": "duplicate"}
    bad = {(r.linea, r.orden, r.problem) for r in checks.sequence_offenders(stops, "linea", "orden").collect()}
    assert bad == {("B", 3, "gap_before"), ("K", 1, "duplicate")}


@pytest.mark.parametrize("times, want", [
    (["2026-01-01 00:00:00", "2026-01-01 00:05:00"], "OK"), (["2026-01-01 00:00:00"], "OK"),
    (["2025-12-31 23:59:59"], "STALE"), ([], "EMPTY"), ([None], "NO_TS"),
])
def test_freshness(spark, times, want):
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    assert checks.check_fresh(df, "ts", 300, "2026-01-01 00:05:00", "x").first().status == want
    exists = checks.check_exists(df, "ts", "x").first()
    assert (exists.status, exists.n) == (("OK_EXISTS", len(times)) if times else ("EMPTY", 0))


def test_missing_tables(spark):
    assert checks.check_fresh(None, "ts", 300, "2026-01-01", "x", spark).first().status == "MISSING"
    assert checks.check_exists(None, "ts", "x", spark).first().status == "MISSING"


def test_retention_edges(spark):
    times = ["2026-01-01 00:00:00", "2026-01-01 00:00:01", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    assert retain(df, "ts", 3600, "2026-01-01 01:00:00").count() == 2  # exactly an hour old has expired
    assert fresh(df, "ts", 3600, "2026-01-01 01:00:00").count() == 2  # and still counts as fresh


def test_document_rules(spark):
    good = spark.createDataFrame([], schemas.STATION_ALERTS)
    assert checks.validate_schema(good, schemas.DOCUMENT_RULES["station_alerts"]).isEmpty()
    for name, schema in [("station_occupancy", schemas.STATION_OCCUPANCY), ("line_delays", schemas.LINE_DELAYS)]:
        assert checks.validate_schema(spark.createDataFrame([], schema), schemas.DOCUMENT_RULES[name]).isEmpty()
    bad = spark.createDataFrame([(None, "x"), ("A", "y")], "station_id string, total_alerts string")
    got = {(r.field, r.violation, r.rows) for r in checks.validate_schema(bad, schemas.DOCUMENT_RULES["station_alerts"]).collect()}
    assert got == {("station_id", "null", 1), ("total_alerts", "type string", None), ("window_end", "absent", None)}


def test_plan_summary(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).selectExpr("id", "id % 3 AS k", "'x' AS unused").write.parquet(path)
    df = spark.read.parquet(path).filter("id > 5").groupBy("k").count()
    found = plan_summary(df)
    assert found["shuffles"] == 1 and found["joins"] == [] and found["python"] == 0
    assert "unused" not in found["read_schema"][0] and "GreaterThan(id,5)" in found["pushed_filters"][0]
    dim = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k long, d date")
    assert plan_summary(df.join(F.broadcast(dim), "k"))["joins"] == ["BroadcastHashJoin"]


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "k string")
    assert checks.check_unique(df, "k").first().observed == "2"
    assert checks.check_unique(df.filter("k = 'a'"), "k").first().status == "OK"
