import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelake.plans import gold
from tidelake.sources import refreshed

SCHEMA = (
    "station_id_origen string, nombre_origen string, municipio_origen string, line string, tipo_servicio string, "
    "hour_block string, time_of_day string, trip_date date, passenger_count int, delay_seconds int, "
    "is_peak_hour boolean, is_holiday boolean"
)


def row(pax, delay=60, line="A", block="09-12", day=dt.date(2024, 4, 1), holiday=False):
    return ("S1", "Niquía", "Bello", line, "metro", block, "mañana", day, pax, delay, block in ("06-09", "15-18"), holiday)


def test_station_volume(spark):
    got = gold.station_volume(spark.createDataFrame([row(10), row(15, 61), row(15, 61)], SCHEMA)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.total_trips, r.total_passengers, r.avg_passengers, r.max_passengers) == (3, 40, 13.33, 15)
    assert (r.avg_delay_seconds, r.day_of_week_num, r.day_name, r.is_weekend) == (60.67, 1, "Lunes", False)


def test_half_way_averages_round_up(spark):
    # 801 / 200 = 4.005, which a binary fraction holds as slightly less.
    rows = [row(4) for _ in range(199)] + [row(5)]
    assert gold.station_volume(spark.createDataFrame(rows, SCHEMA)).first().avg_passengers == 4.01


def test_empty_splits_are_null(spark):
    r = gold.line_month_delay(spark.createDataFrame([row(10, 100), row(10, 200)], SCHEMA)).first()
    assert (r.avg_delay_seconds, r.avg_delay_offpeak, r.avg_delay_nonholiday) == (150.0, 150.0, 150.0)
    assert r.avg_delay_peak is None and r.avg_delay_holiday is None
    assert (r.total_holiday_trips, r.month_name, r.is_rainy_month) == (0, "Abril", True)


def test_threshold_is_not_high_demand(spark):
    rows = [row(p) for p in [1, 2, 3, 4, 5, 6, 7, 8, 9, 9]]
    r = gold.high_demand_share(spark.createDataFrame(rows, SCHEMA)).first()
    assert (r.p90_line_threshold, r.high_demand_trips, r.pct_high_demand) == (9, 0, 0.0)


def test_threshold_spans_blocks_of_a_line(spark):
    rows = [row(p, block="09-12") for p in range(1, 91)] + [row(p, block="12-15") for p in range(91, 101)]
    rows += [row(400, line="B")]
    got = {(r.line, r.hour_block): r for r in gold.high_demand_share(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["A", "09-12"].p90_line_threshold == 90 and got["A", "09-12"].high_demand_trips == 0
    assert got["A", "12-15"].high_demand_trips == 10 and got["A", "12-15"].pct_high_demand == 100.0
    assert got["B", "09-12"].p90_line_threshold == 400


@pytest.mark.parametrize("n", [1, 9, 10, 11, 25000])
def test_percentile_matches_brute_force(spark, n):
    rng = random.Random(n)
    values = sorted(rng.randint(1, 400) for _ in range(n))
    want = values[-(-9 * n // 10) - 1]
    df = spark.createDataFrame([("A", v) for v in values], "line string, passenger_count int")
    assert gold.line_thresholds(df).first().p90_threshold == want


def test_unknown_passengers_do_not_shift_the_threshold(spark):
    rows = [row(p) for p in range(1, 11)] + [row(None)] * 50
    r = gold.high_demand_share(spark.createDataFrame(rows, SCHEMA)).first()
    assert (r.p90_line_threshold, r.high_demand_trips, r.total_trips, r.avg_passengers) == (9, 1, 60, 5.5)


def test_rollups_are_unweighted(spark):
    delays = spark.createDataFrame(
        [("metro", True, 10.0, 1.0, 1), ("metro", True, 20.01, None, 999)],
        "tipo_servicio string, is_rainy_month boolean, avg_delay_seconds double, avg_delay_peak double, total_trips long",
    )
    r = gold.season_rollup(delays).first()
    assert (r.avg_delay, r.avg_delay_peak, r.total_trips) == (15.01, 1.0, 1000)


def test_top_slots_break_ties_by_key(spark):
    slots = spark.createDataFrame(
        [(s, "n", "m", "06-09", 1, "Lunes", False, 5, 9.0, 1.0) for s in ("S3", "S1", "S2")]
        + [("S0", "n", "m", "06-09", 6, "Sábado", True, 5, 99.0, 1.0), ("S0", "n", "m", "09-12", 1, "Lunes", False, 5, 99.0, 1.0)],
        "station_id string, nombre_estacion string, municipio string, hour_block string, day_of_week_num int, "
        "day_name string, is_weekend boolean, total_trips long, avg_passengers double, avg_delay_seconds double",
    )
    assert [r.station_id for r in gold.top_slots(slots, 2).collect()] == ["S1", "S2"]
    assert gold.station_rollup(slots, 1).first().avg_pax_global == 99.0
    assert gold.top_slots(slots, 9, blocks=["09-12"]).count() == 1


def test_one_scan_for_high_demand(spark, tmp_path):
    from tidelake.operators.inspect import plan_text

    path = str(tmp_path / "t")
    spark.createDataFrame([row(1)], SCHEMA).write.parquet(path)
    text = plan_text(gold.high_demand_share(spark.read.parquet(path)))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Join" not in tree


def test_write_gold_returns_rows(spark, tmp_path):
    path = str(tmp_path / "g")
    assert gold.write_gold(path, spark.range(7)) == 7
    assert gold.write_gold(path, spark.range(3)) == 3
    assert refreshed.read(spark, path).agg(F.max("id")).first()[0] == 2
