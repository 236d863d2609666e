import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.operators.runs import running_sum_with_resets
from tidelake.session import scratch
from tidelake.streaming import alerts, store
from tidelake.streaming.events import timed_events
from tests.test_streaming import START, message, write_files


def brute_force(events, terminals, threshold=300):
    """(vehicle, event id, accumulated) of every first crossing, one event after another."""
    state, fired = {}, []
    for e in sorted(events, key=lambda e: (e["timestamp"], e["event_id"])):
        total, alerted = state.get(e["vehicle_id"], (0, False))
        if e["event_type"] == "departure":
            total += e["delay_seconds"]
            if total > threshold and not alerted:
                fired.append((e["vehicle_id"], e["event_id"], total))
                alerted = True
        elif e["event_type"] == "arrival" and e["stop_id"] in terminals:
            total, alerted = 0, False
        state[e["vehicle_id"]] = (total, alerted)
    return sorted(fired)


RUN = [
    message(0, "departure", "A1", delay=200), message(60, "departure", "A2", delay=100),  # 300 is not above
    message(120, "arrival", "A2"), message(121, "departure", "A2", delay=1),  # 301: alert
    message(180, "departure", "A2", delay=500),  # no second alert in the run
    message(240, "arrival", "A3"),  # terminal: starts anew
    message(300, "departure", "A3", delay=299), message(4000, "departure", "A2", delay=2),  # alert, an hour later
    message(4001, "departure", "A2", delay=400, vehicle="V2"),
]


def random_events(seed, n=400):
    rng = random.Random(seed)
    return [message(rng.randrange(20000), rng.choice(["arrival", "departure", "departure", "delay_alert"]),
                    rng.choice(["A1", "A2", "A2", "K1", "X"]), delay=rng.randrange(-20, 150),
                    vehicle=rng.choice(["V1", "V1", "V1", "V2", "V3"]), event_id=f"e{i:04}") for i in range(n)]


def batch_alerts(spark, tmp_path, catalog, events, **options):
    write_files(tmp_path / "in", events)
    rows = timed_events(spark.read.schema(schemas.RAW_STREAM).json(str(tmp_path / "in")))
    got = alerts.delay_edge_alerts(rows, catalog[0], **options).collect()
    return sorted((r.vehicle_id, r.event_id, r.accumulated_delay) for r in got)


TERMINALS = {"A1", "A3", "K1", "K2"}


@pytest.mark.parametrize("slice_by", ["MINUTE", "HOUR", "DAY"])
def test_edges(spark, catalog, tmp_path, slice_by):
    got = batch_alerts(spark, tmp_path, catalog, RUN, slice_by=slice_by)
    assert got == brute_force(RUN, TERMINALS)
    assert [(v, t) for v, _, t in got] == [("V1", 301), ("V1", 301), ("V2", 400)]


@pytest.mark.parametrize("seed, slice_by", [(1, "MINUTE"), (2, "HOUR"), (3, "DAY")])
def test_edges_match_brute_force(spark, catalog, tmp_path, seed, slice_by):
    events = random_events(seed)
    got = batch_alerts(spark, tmp_path, catalog, events, slice_by=slice_by)
    assert got == brute_force(events, TERMINALS) and len(got) > 10


@pytest.mark.parametrize("cuts", [[2, 4, 7]])
def test_carried_edges(spark, catalog, tmp_path, cuts):
    bounds = [0, *cuts, len(RUN)]
    carried(spark, catalog, tmp_path, [RUN[a:b] for a, b in zip(bounds, bounds[1:])], RUN)


def test_carried_edges_match_brute_force(spark, catalog, tmp_path):
    events = sorted(random_events(5), key=lambda e: (e["timestamp"], e["event_id"]))
    carried(spark, catalog, tmp_path, [events[:150], events[150:160], events[160:]], events)


def carried(spark, catalog, tmp_path, batches, events):
    root = scratch(spark, "carried")
    sink = alerts.edge_alert_writer(f"{root}/state", f"{root}/alerts", slice_by="MINUTE", key=lambda batch, n: f"q-{n}")
    for n, batch in enumerate(batches):
        write_files(tmp_path / f"in{n}", batch)
        rows = timed_events(spark.read.schema(schemas.RAW_STREAM).json(str(tmp_path / f"in{n}")))
        moves = alerts.mark_terminals(rows, catalog[0])
        sink(moves, n)
        sink(moves, n)  # a replay
        if n == 1:
            store.merge(spark, f"{root}/alerts", alerts.ALERTS, "vehicle_id")
        assert len(alerts._snapshots(spark, f"{root}/state")) <= 2
    fired = store.rows(spark, f"{root}/alerts", alerts.ALERTS)
    got = sorted((r.vehicle_id, r.event_id, r.accumulated_delay) for r in fired.collect())
    assert got == brute_force(events, TERMINALS)


def test_movements_without_vehicle_are_no_vehicle(spark, catalog, tmp_path):
    events = [message(0, "departure", delay=200, vehicle=""), message(60, "departure", delay=200, vehicle=""), message(70, "departure", delay=301, vehicle="V9")]
    nameless = dict(message(80, "departure", delay=900))
    del nameless["vehicle_id"]
    write_files(tmp_path / "in", [*events, nameless])
    rows = timed_events(spark.read.schema(schemas.RAW_STREAM).json(str(tmp_path / "in")))
    assert [r.vehicle_id for r in alerts.delay_edge_alerts(rows, catalog[0]).collect()] == ["V9"]
    assert alerts.without_vehicle(rows).first().without_vehicle == 3


def test_a_terminal_of_two_lines_counts_once(spark, catalog, tmp_path, monkeypatch):
    twice = catalog[0].unionByName(catalog[0].filter("stop_id = 'A1'").selectExpr("stop_id", "station_id", "'B' AS linea", "1 AS orden", "tipo_servicio"))
    write_files(tmp_path / "in", [message(0, "departure", "A1", delay=200)])
    rows = timed_events(spark.read.schema(schemas.RAW_STREAM).json(str(tmp_path / "in")))
    assert alerts.delay_edge_alerts(rows, twice).count() == 0
    monkeypatch.setattr(alerts, "broadcast_if_small", lambda df: df)
    marked = alerts.mark_terminals(rows, twice)
    assert marked.count() == 1 and set(marked.columns) == {*rows.columns, "at_terminal"}


def test_one_vehicle_with_most_events(spark, catalog, tmp_path):
    rng = random.Random(8)
    events = [message(rng.randrange(200_000), "departure", rng.choice(["A2", "X"]), delay=rng.randrange(-50, 60),
                      vehicle="V1" if i % 10 else f"V{i}", event_id=f"e{i:05}") for i in range(1500)]
    assert batch_alerts(spark, tmp_path, catalog, events, slice_by="HOUR") == brute_force(events, TERMINALS)


def test_running_sum_over_a_dominant_key(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 4 < 3, "hot").otherwise("cold").alias("k"), "id", (F.col("id") % 7).alias("x"),
        (F.col("id") % 50 == 0).alias("stop"),
    )
    got = running_sum_with_resets(df, "k", ["id"], F.col("x"), F.col("stop"), F.floor(F.col("id") / 90)).collect()
    state = {}
    for r in sorted(got, key=lambda r: r.id):
        run, total = state.get(r.k, (0, 0))
        total += r.x
        assert (r.run, r.running) == (run, total)
        state[r.k] = (run + 1, 0) if r.stop else (run, total)
    assert len(got) == 2000


def test_capacity(spark):
    at = dt.datetime(2026, 1, 1)
    rows = [("arrival", "A", 1080), ("arrival", "A", 1081), ("arrival", "TA", 270), ("arrival", "TA", 271),
            ("arrival", "K", 45), ("arrival", "K", 46), ("departure", "K", 50)]
    df = spark.createDataFrame([(*r, at) for r in rows], "event_type string, line string, passenger_count int, event_time timestamp")
    got = {(r.line, r.passenger_count, r.capacity) for r in alerts.capacity_alerts(df).collect()}
    assert got == {("A", 1081, 1200), ("TA", 271, 300), ("K", 46, 50)}
