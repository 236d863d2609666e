"""Operational questions on the current-state and history tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.events import before
from tidelake.operators.ranking import with_rank

HOUR = 3600


def occupancy_of(latest: DataFrame, station_id: str) -> DataFrame:
    """Current occupancy of one station."""
    return latest.filter(F.col("station_id") == station_id)


def top_occupancy(latest: DataFrame, n: int = 5) -> DataFrame:
    """Stations with the fullest vehicles now, numbered from 1."""
    ranked = with_rank(latest, n, "avg_vehicle_occupancy", "station_id")
    return ranked.select(
        "rank", "station_id", "stop_name", "lines_serving", "avg_vehicle_occupancy",
        "max_vehicle_occupancy", "event_count", "window_end",
    )


def critical_lines(latest: DataFrame) -> DataFrame:
    """Lines with at least one badly delayed vehicle, worst first."""
    return (
        latest.filter("high_delay")
        .select(
            "line", "tipo_servicio", "avg_delay_seconds", "max_delay_seconds",
            "vehicles_seen", "vehicles_delayed", "window_end",
        )
        .orderBy(F.desc("max_delay_seconds"), "line")
    )


def alert_rollup(
    alerts: DataFrame, as_of: Column | str, station_id: str | None = None, seconds: int = HOUR
) -> DataFrame:
    """Alerts per station over the last hour, for all stations or one."""
    recent = alerts.filter(F.col("window_end") >= before(as_of, seconds))
    if station_id is not None:
        recent = recent.filter(F.col("station_id") == station_id)
    return recent.groupBy("station_id").agg(
        F.min_by("stop_name", "window_end").alias("stop_name"),
        F.sum("delay_alerts").alias("delay_alerts"),
        F.sum("capacity_alerts").alias("capacity_alerts"),
        F.sum("total_alerts").alias("total_alerts"),
        F.count(F.lit(1)).alias("windows_seen"),
        F.min("window_end").alias("first_window"),
        F.max("window_end").alias("last_window"),
    )


def top_alerts(rollup: DataFrame, n: int = 5) -> DataFrame:
    """Stations with most alerts, numbered from 1."""
    ranked = with_rank(rollup, n, "total_alerts", "station_id")
    return ranked.select(
        "rank", "station_id", "stop_name", "delay_alerts", "capacity_alerts", "total_alerts", "windows_seen"
    )
