import datetime as dt
import math

from tidelake.plans import integration, serving

END = dt.datetime(2026, 5, 18, 14, 0)  # a Monday, block 12-15
AS_OF = "2026-05-18 14:04:00"
OCC = (
    "station_id string, stop_name string, lines_serving array<string>, window_end timestamp, "
    "max_vehicle_occupancy int, avg_vehicle_occupancy double, event_count long"
)
VOL = (
    "station_id string, nombre_estacion string, hour_block string, day_of_week_num int, total_trips long, "
    "avg_passengers double, avg_delay_seconds double"
)


def current(spark, values, end=END):
    rows = [(s, f"name {s}", ["A", "K"] if s == "S1" else ["A"], end, 9, float(v), 12) for s, v in values.items()]
    return spark.createDataFrame(rows, OCC)


def history(spark, values, trips=10):
    return spark.createDataFrame([(s, s, "12-15", 1, trips, float(v), 1.0) for s, v in values.items()], VOL)


def sides(spark, now, past):
    return integration.current_readings(current(spark, now), AS_OF), integration.history_slot(history(spark, past), AS_OF)


def test_scores_over_common_stations_only(spark):
    now, past = {"S1": 100, "S2": 200, "S3": 600, "new": 9999}, {"S1": 30, "S2": 20, "S3": 10, "gone": 7777}
    rows = {r.station_id: r for r in integration.zscore_ranking(*sides(spark, now, past)).collect()}
    assert set(rows) == {"S1", "S2", "S3"}
    mu = 300.0
    sigma = math.sqrt(sum((v - mu) ** 2 for v in (100, 200, 600)) / 3)
    past_sigma = math.sqrt(200 / 3)
    z, h = (600 - mu) / sigma, (10 - 20) / past_sigma
    assert (rows["S3"].z_stream, rows["S3"].z_hist, rows["S3"].delta_z) == (round(z, 2), round(h, 2), round(z - h, 2))
    assert rows["S1"].multimodal and rows["S1"].lines == "A,K" and not rows["S2"].multimodal
    assert rows["S3"].flag == "▲▲" and rows["S1"].flag == "▼▼" and rows["S3"].window_end == "14:00:00Z"
    order = [r.station_id for r in integration.zscore_ranking(*sides(spark, now, past)).collect()]
    assert order == ["S3", "S2", "S1"]
    ctx = integration.zscore_context(*sides(spark, now, past)).first()
    assert (ctx.n_common, ctx.n_only_stream, ctx.n_only_hist) == (3, 1, 1)
    assert (ctx.mu_stream, ctx.sigma_stream, ctx.mu_batch, ctx.sigma_b_zero) == (300.0, round(sigma, 1), 20.0, False)


def test_flat_history(spark):
    rows = integration.zscore_ranking(*sides(spark, {"S1": 1, "S2": 3}, {"S1": 5, "S2": 5})).collect()
    assert [(r.station_id, r.z_hist, r.delta_z) for r in rows] == [("S2", 0.0, 1.0), ("S1", 0.0, -1.0)]
    assert integration.zscore_context(*sides(spark, {"S1": 1, "S2": 3}, {"S1": 5, "S2": 5})).first().sigma_b_zero


def test_single_and_no_common_station(spark):
    assert integration.zscore_ranking(*sides(spark, {"S1": 4}, {"S1": 5})).first().delta_z == 0.0
    assert integration.zscore_ranking(*sides(spark, {"S1": 4}, {"S2": 5})).isEmpty()
    ctx = integration.zscore_context(*sides(spark, {"S1": 4}, {"S2": 5})).first()
    assert (ctx.n_common, ctx.mu_stream, ctx.sigma_batch, ctx.sigma_b_zero) == (0, 0.0, 0.0, True)


def test_slot_and_freshness(spark):
    thin = history(spark, {"S1": 1}, trips=4)
    assert integration.history_slot(thin, AS_OF).isEmpty()
    assert integration.history_slot(history(spark, {"S1": 1}, trips=5), AS_OF).count() == 1
    assert integration.history_slot(history(spark, {"S1": 1}), "2026-05-19 14:04:00").isEmpty()
    assert integration.history_slot(history(spark, {"S1": 1}), "2026-05-18 18:04:00", zone="America/Bogota").count() == 1
    assert integration.current_readings(current(spark, {"S1": 1}), "2026-05-18 14:05:00").count() == 1
    assert integration.current_readings(current(spark, {"S1": 1}), "2026-05-18 14:05:01").isEmpty()


def test_extremes(spark):
    ranking = spark.createDataFrame([(f"S{i:02}", float(i - 3)) for i in range(20)], "station_id string, delta_z double")
    got = integration.rank_delta(ranking).collect()
    assert [r.delta_z for r in got if r.side == "top"] == [float(v) for v in range(16, 6, -1)]
    assert [r.delta_z for r in got if r.side == "bottom"] == [-3.0, -2.0, -1.0]
    assert tuple(integration.delta_counts(ranking).first()) == (16, 4)


def test_serving(spark):
    latest = current(spark, {"S1": 5, "S2": 7, "S3": 7})
    assert [(r.rank, r.station_id) for r in serving.top_occupancy(latest, 2).collect()] == [(1, "S2"), (2, "S3")]
    assert serving.occupancy_of(latest, "S1").count() == 1
    alerts = spark.createDataFrame(
        [("S1", "n", 1, 2, 3, END), ("S1", "n", 1, 0, 1, dt.datetime(2026, 5, 18, 13, 4)),
         ("S1", "n", 9, 9, 18, dt.datetime(2026, 5, 18, 13, 3)), ("S2", "m", 4, 0, 4, END)],
        "station_id string, stop_name string, delay_alerts long, capacity_alerts long, total_alerts long, window_end timestamp",
    )
    rollup = serving.alert_rollup(alerts, AS_OF)
    got = {r.station_id: (r.delay_alerts, r.capacity_alerts, r.total_alerts, r.windows_seen) for r in rollup.collect()}
    assert got == {"S1": (2, 2, 4, 2), "S2": (4, 0, 4, 1)}
    assert [r.station_id for r in serving.top_alerts(rollup, 1).collect()] == ["S1"]
    assert serving.alert_rollup(alerts, AS_OF, "S2").count() == 1
    delays = spark.createDataFrame(
        [("A", "metro", 1.0, 400, 3, 1, END, True), ("B", "metro", 1.0, 900, 3, 1, END, True), ("K", "cable", 9.0, 10, 3, 0, END, False)],
        "line string, tipo_servicio string, avg_delay_seconds double, max_delay_seconds int, vehicles_seen long, "
        "vehicles_delayed long, window_end timestamp, high_delay boolean",
    )
    assert [r.line for r in serving.critical_lines(delays).collect()] == ["B", "A"]
