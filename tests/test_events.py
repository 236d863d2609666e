import json

import pytest
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.streaming import events as ev

FULL = {"event_id": "e", "event_type": "arrival", "stop_id": "A1", "line": "A", "vehicle_id": "V", "passenger_count": 7,
        "delay_seconds": 8, "timestamp": "2026-05-18T14:32:59.954Z"}


def parse(spark, *bodies):
    df = spark.createDataFrame([(b, None) for b in bodies], schemas.RAW_STREAM)
    return ev.parse_events(df).drop("source_ts").collect()


def body(**changes):
    return json.dumps({**FULL, **changes})


def without(name):
    return json.dumps({k: v for k, v in FULL.items() if k != name})


INVALID = ("", "_invalid", "", "", "", 0, 0, "")


def test_complete_event(spark):
    assert [tuple(r) for r in parse(spark, body())] == [tuple(FULL.values())]


@pytest.mark.parametrize("name, default", [("event_id", ""), ("event_type", "_invalid"), ("stop_id", ""), ("line", ""),
                                           ("vehicle_id", ""), ("passenger_count", 0), ("delay_seconds", 0), ("timestamp", "")])
def test_absent_field_takes_default(spark, name, default):
    row = parse(spark, without(name))[0]
    assert row[name] == default
    assert all(row[k] == v for k, v in FULL.items() if k != name)


@pytest.mark.parametrize("value, want", [("12", 12), (3.7, 3), (True, 1), (0, 0), (-4, -4)])
def test_readable_numbers(spark, value, want):
    assert parse(spark, body(passenger_count=value))[0].passenger_count == want


@pytest.mark.parametrize("value", [None, "x", "3.7", "", [1], {"a": 1}])
def test_unreadable_number_voids_the_event(spark, value):
    assert tuple(parse(spark, body(passenger_count=value))[0]) == INVALID
    assert tuple(parse(spark, body(delay_seconds=value))[0]) == INVALID


@pytest.mark.parametrize("text", ["5", "[1]", '"s"', "null", "true", "garbage", "", '{"a": 1', None, "{} x"])
def test_non_objects_are_invalid(spark, text):
    assert tuple(parse(spark, text)[0]) == INVALID


def test_last_of_repeated_fields_counts(spark):
    assert parse(spark, '{"event_type": "arrival", "line": "A", "line": "B"}')[0].line == "B"


def test_empty_object_is_all_defaults(spark):
    assert tuple(parse(spark, " \n{}")[0]) == INVALID  # the absent type makes it invalid as well


def test_null_event_type_is_not_invalid(spark):
    df = spark.createDataFrame([(body(event_type=None), None), (without("event_type"), None)], schemas.RAW_STREAM)
    kept = ev.valid_events(ev.parse_events(df)).collect()
    assert [r.event_type for r in kept] == [None]


def test_body_is_parsed_once(spark):
    from tidelake.operators.inspect import plan_text

    df = spark.read.schema(schemas.RAW_STREAM).json(spark.sparkContext.emptyRDD())
    timed = ev.timed_events(df).filter("delay_seconds >= 0 AND event_type = 'arrival'")
    assert plan_text(timed).count("tryParseJson") <= 2  # once in the plan, once if shown again among its inputs


def test_unknown_stop_stands_for_itself(spark, catalog):
    stops, stations = catalog
    stops = stops.unionByName(spark.createDataFrame([("B1", "S9", "B", 1, "metro")], stops.schema))
    df = spark.createDataFrame([("A1",), ("K1",), ("B1",), ("X",), (None,)], "stop_id string")
    got = {r.stop_id: (r.station_id, r.stop_name) for r in ev.enrich_events(df, stops, stations).collect()}
    assert got == {"A1": ("S1", "Niquía"), "K1": ("S2", "Acevedo"), "B1": ("S9", "S9"), "X": ("X", "X"), None: (None, None)}


def test_salted_join_gives_the_same(spark, catalog, monkeypatch):
    stops, stations = catalog
    df = spark.range(200).select(
        F.col("id").cast("string").alias("event_id"), F.lit("V").alias("vehicle_id"),
        F.current_timestamp().alias("event_time"), F.when(F.col("id") % 3 == 0, "X").otherwise("A1").alias("stop_id"),
    )
    plain = ev.enrich_events(df, stops, stations).groupBy("station_id", "stop_name").count().collect()
    monkeypatch.setattr(ev, "is_small", lambda frame, **more: False)
    salted = ev.enrich_events(df, stops, stations, salts=4)
    assert salted.columns == ["event_id", "vehicle_id", "event_time", "stop_id", "station_id", "stop_name"]
    assert sorted(salted.groupBy("station_id", "stop_name").count().collect()) == sorted(plain)


def test_events_are_not_shuffled_where_stops_and_names_are_small(spark, catalog, monkeypatch):
    stops, stations = catalog
    df = spark.createDataFrame([("A1",), ("K1",), ("X",), (None,)], "stop_id string")
    plain = ev.enrich_events(df, stops, stations)
    monkeypatch.setattr(ev, "is_small", lambda frame, key=None: key is None)
    narrow = ev.enrich_events(df, stops, stations)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, plain.collect()))
    assert narrow._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2
