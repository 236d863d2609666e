import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import BATCHES, START, message, write_files
from tidelake.operators.inspect import plan_summary, plan_text
from tidelake.operators.retention import unexpired
from tidelake.schemas import RAW_STREAM, struct
from tidelake.sources import refreshed, streams
from tidelake.streaming import alerts, jobs, sinks, store, windows
from tidelake.streaming.events import enrich_events, timed_events

ROWS = struct("k string, n int, at timestamp")


def batch(spark, *rows):
    return spark.createDataFrame([(k, n, START + dt.timedelta(minutes=n)) for k, n in rows], ROWS)


def content(spark, path):
    spark.catalog.refreshByPath(path)
    return sorted((r.k, r.n) for r in store.rows(spark, path, ROWS).collect())


def data_files(path):
    return [f for f in Path(path).rglob("*.parquet") if "_temporary" not in f.parts]


def test_merged_batches_are_read_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert store.merge(spark, path, ROWS, "k") == 0 and not store.exists(spark, path) and not (tmp_path / "t").exists()
    for n in range(3):
        store.put(batch(spark, ("a", n), ("b", n)), path, f"q-{n}")
    want = [(k, n) for k in "ab" for n in range(3)]
    assert content(spark, path) == want
    assert store.merge(spark, path, ROWS, "k") == 3 and content(spark, path) == want
    assert store.merge(spark, path, ROWS, "k") == 0
    store.put(batch(spark, ("a", 2), ("b", 2)), path, "q-2")  # replayed after it was merged
    store.put(batch(spark, ("c", 9)), path, "q-3")
    store.put(batch(spark, ("d", 7)), path, "other-0")  # a new checkpoint counts from 0
    assert content(spark, path) == [*want, ("c", 9), ("d", 7)]
    store.merge(spark, path, ROWS, "k")
    assert content(spark, path) == [*want, ("c", 9), ("d", 7)]
    with pytest.raises(ValueError):
        store.put(batch(spark), path, "no number")


def test_a_merge_that_dies_anywhere_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(4):
        store.put(batch(spark, ("a", n)), path, f"q-{n}")
    want = content(spark, path)
    with monkeypatch.context() as m:  # before the base is there
        m.setattr(refreshed, "replace", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.merge(spark, path, ROWS, "k")
    assert content(spark, path) == want
    kept = store._fresh(spark, path)
    real = refreshed.files_of

    class NoDelete:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            if name == "delete":
                raise RuntimeError("killed")
            return getattr(self.files, name)

    with monkeypatch.context() as m:  # after the base is there, before its batches go
        m.setattr(store.refreshed, "files_of", lambda s, p: (NoDelete(real(s, p)[0]), real(s, p)[1]) if "fresh/batch=" in p else real(s, p))
        with pytest.raises(RuntimeError):
            store.merge(spark, path, ROWS, "k")
    assert store._fresh(spark, path) == kept and content(spark, path) == want
    store.put(batch(spark, ("a", 9)), path, "q-4")
    store.merge(spark, path, ROWS, "k")
    assert content(spark, path) == [*want, ("a", 9)] and store._fresh(spark, path) == []


def test_a_batch_written_during_a_merge_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store.put(batch(spark, ("a", 0), ("old", -100)), path, "q-0")
    real = refreshed.replace

    def slow(*args, **more):
        folder = real(*args, **more)
        store.put(batch(spark, ("a", 1)), path, "q-1")
        return folder

    monkeypatch.setattr(refreshed, "replace", slow)
    store.merge(spark, path, ROWS, "k", unexpired("at", 3600, str(START)))
    assert content(spark, path) == [("a", 0), ("a", 1)]


def test_files_stay_few_over_many_batches(spark, tmp_path):
    path, most = str(tmp_path / "t"), 0
    writer = sinks.every(sinks.window_writer(path, lambda b, n: f"q-{n}"), 6, lambda s: store.merge(s, path, ROWS, "k", folders=2))
    for n in range(30):
        writer(batch(spark, ("a", n), ("b", n)).coalesce(1), n)
        most = max(most, len(data_files(path)))
    assert content(spark, path) == [(k, n) for k in "ab" for n in range(30)]
    # At most six batches beside two bases of two folders with a file for each part, and their marks.
    assert most <= 6 + 2 * (2 * store.PARTS + 1)


def test_a_lookup_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    store.put(batch(spark, *[(f"s{n % 40}", n) for n in range(400)]), path, "q-0")
    store.merge(spark, path, ROWS, "k")
    store.put(batch(spark, ("s7", 1000), ("s8", 1000)), path, "q-1")
    found = store.lookup(spark, path, ROWS, "k", "s7")
    assert sorted(r.n for r in found.collect()) == [*range(7, 400, 40), 1000]
    plan = plan_summary(found)
    assert any(store._FOLDER in f for f in plan["partition_filters"]) and any("EqualTo(k,s7)" in f for f in plan["pushed_filters"])
    base = refreshed.current(spark, f"{path}/base")
    whole = spark.read.parquet(base).filter(f"{store._FOLDER} >= 0")
    one = spark.read.parquet(base).filter(F.col(store._FOLDER) == store._folder_of(F.lit("s7"), store.FOLDERS))
    assert len({r[0] for r in one.select(F.input_file_name()).distinct().collect()}) < len({r[0] for r in whole.select(F.input_file_name()).distinct().collect()})
    assert store.lookup(spark, path, ROWS, "k", "none").collect() == []


def test_a_bloom_filter_spares_the_row_groups(spark, tmp_path):
    """A key between a file's least and largest that is not in it: the scan reads no row."""
    path = str(tmp_path / "t")
    store.put(batch(spark, *[(f"s{2 * n:04}", n) for n in range(2000)]), path, "q-0")
    store.merge(spark, path, ROWS, "k", folders=1, expected=2000)
    base = spark.read.parquet(refreshed.current(spark, f"{path}/base")).filter(f"{store._FOLDER} = 0")

    def scanned(value):
        frame = base.filter(F.col("k") == value)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves() if "Adaptive" not in plan.getClass().getSimpleName() else plan.executedPlan().collectLeaves()
        return leaves.head().metrics().apply("numOutputRows").value()

    assert scanned("s1000") > 0 == scanned("s1001")


def test_one_scan_and_one_parse_for_three_tables(spark, catalog, tmp_path):
    write_files(tmp_path / "in", [m for b in BATCHES for m in b])
    raw = spark.read.schema(RAW_STREAM).json(str(tmp_path / "in"))
    enriched = enrich_events(timed_events(raw), *catalog)
    fanned = windows.fan_out(enriched)
    text = plan_text(fanned).split("\n\n")[0]
    assert text.count("Scan json") == 1 and text.count("Generate") == 2  # the parse, and the rows per table
    direct = {"station_occupancy": windows.station_occupancy(enriched), "line_delays": windows.line_delays(enriched), "station_alerts": windows.station_alerts(enriched)}
    for name, rows in direct.items():
        got, want = windows.split(fanned, name).drop("last_updated"), rows.drop("last_updated")
        assert got.columns == want.columns and want.count() > 0
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
        alone = windows.split(windows.fan_out(enriched, only=[name]), name).drop("last_updated")
        assert alone.exceptAll(want).isEmpty() and want.exceptAll(alone).isEmpty(), name


def test_purge_beside_a_running_stream_loses_no_window(spark, catalog, tmp_path):
    """The tables are merged and purged again and again while the stream closes windows."""
    root, folder = str(tmp_path / "ops"), tmp_path / "in"
    minutes = [[message(60 * n, "delay_alert", event_id=f"e{n}")] for n in range(12)]
    write_files(folder, *minutes, [message(3000)], [message(3001)])
    raw = streams.file_stream(spark, str(folder), "json", files_per_trigger=1)
    (query,) = jobs.start_all(raw, *catalog, root, jobs.StreamSettings(trigger={"availableNow": True}, log=True, merge_every=4))
    as_of, rounds = str(START + dt.timedelta(minutes=10)), 0
    while query.isActive:
        store.rows(spark, f"{root}/station_alerts", jobs.OPERATIONAL["station_alerts"][0]).collect() if rounds < 3 else time.sleep(0.2)
        rounds += 1
    assert query.exception() is None
    jobs.purge_all(spark, root, as_of)
    schema = jobs.OPERATIONAL["line_delays"][0]
    assert store.rows(spark, f"{root}/line_delays", schema).count() == 12


def test_time_of_a_batch_does_not_grow(spark, catalog, tmp_path):
    """Vehicle runs: the state read and written is that of the open runs, however many batches came before."""
    root = str(tmp_path / "ops")
    sink = alerts.edge_alert_writer(f"{root}/runs", f"{root}/alerts", ttl="2 hours", key=lambda b, n: f"q-{n}")
    sink = sinks.every(sink, 20, lambda s: store.merge(s, f"{root}/alerts", alerts.ALERTS, "vehicle_id", folders=1))
    took: list[float] = []
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    for n in range(40):
        moves = spark.createDataFrame(
            [(f"V{n}", START + dt.timedelta(minutes=5 * n), f"e{n}", "departure", "A", "A2", 200, False), ("V", START + dt.timedelta(minutes=5 * n), f"v{n}", "departure", "A", "A2", 10, False)],
            "vehicle_id string, event_time timestamp, event_id string, event_type string, line string, stop_id string, delay_seconds int, at_terminal boolean",
        )
        began = time.perf_counter()
        sink(moves, n)
        took.append(time.perf_counter() - began)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sum(took[-10:]) < 2 * sum(took[5:15])
    runs = {r.vehicle_id: r.accumulated for r in alerts.open_runs(spark, f"{root}/runs").collect()}
    assert runs["V"] == 400 and len(runs) <= 26  # vehicles without a move for two hours have left
    assert [r.accumulated_delay for r in store.rows(spark, f"{root}/alerts", alerts.ALERTS).collect()] == [310]
    assert len(list(Path(root, "runs").glob("after=*"))) == 2
