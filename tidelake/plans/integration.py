"""Present load against history: where has a station's position among its peers moved?

Both sides are standardised over the stations they share, then compared. The
levels themselves differ in kind (vehicle load, trip load) and are never subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions import calendar
from tidelake.functions.events import delta_flag, instant, is_multimodal, joined_lines
from tidelake.operators.ranking import moments, top_n, zscore
from tidelake.operators.retention import fresh

FRESH_SECONDS = 300
MIN_HISTORY_TRIPS = 5


def current_readings(occupancy: DataFrame, as_of: Column | str, seconds: int = FRESH_SECONDS) -> DataFrame:
    """Latest closed window per station, if recent enough."""
    return fresh(occupancy, "window_end", seconds, as_of).select(
        "station_id", "stop_name", "lines_serving", "avg_vehicle_occupancy",
        "max_vehicle_occupancy", "event_count", "window_end",
    )


def history_slot(
    volume: DataFrame, as_of: Column | str, min_trips: int = MIN_HISTORY_TRIPS, zone: str | None = None
) -> DataFrame:
    """Historical volume in the service block and weekday of ``as_of``, thin cells left out."""
    now = instant(as_of)
    local = F.from_utc_timestamp(now, zone) if zone else now
    return volume.filter(
        (F.col("hour_block") == calendar.hour_block(local))
        & (F.col("day_of_week_num") == calendar.iso_dow(local))
        & (F.col("total_trips") >= min_trips)
    ).select("station_id", "nombre_estacion", "avg_passengers", "total_trips", "avg_delay_seconds")


def match_sides(current: DataFrame, history: DataFrame, key: str = "station_id") -> DataFrame:
    """Both sides by key, with ``in_current`` and ``in_history``."""
    left = current.withColumn("_in_current", F.lit(True))
    right = history.withColumn("_in_history", F.lit(True))
    return (
        left.join(right, key, "full_outer")
        .withColumns(
            {
                "in_current": F.coalesce("_in_current", F.lit(False)),
                "in_history": F.coalesce("_in_history", F.lit(False)),
            }
        )
        .drop("_in_current", "_in_history")
    )


def _pair_moments() -> list[Column]:
    mu_s, sigma_s = moments(F.col("avg_vehicle_occupancy"))
    mu_b, sigma_b = moments(F.col("avg_passengers"))
    return [mu_s.alias("mu_s"), sigma_s.alias("sigma_s"), mu_b.alias("mu_b"), sigma_b.alias("sigma_b")]


def zscore_ranking(current: DataFrame, history: DataFrame) -> DataFrame:
    """One row per shared station with both scores and their difference, largest rise first.

    The four network figures reach the rows as one scalar subquery.
    """
    common = current.join(history, "station_id")
    network = common.agg(*_pair_moments()).select(F.struct("*").alias("network")).scalar()
    now, past = F.col("avg_vehicle_occupancy"), F.col("avg_passengers")
    scored = (
        common.withColumn("_network", network)
        .withColumns(
            {
                "_zs": zscore(now, F.col("_network.mu_s"), F.col("_network.sigma_s")),
                "_zb": zscore(past, F.col("_network.mu_b"), F.col("_network.sigma_b")),
            }
        )
        .withColumn("delta_z", F.round(F.col("_zs") - F.col("_zb"), 2))
    )
    return scored.select(
        "station_id",
        F.coalesce("stop_name", "station_id").alias("stop_name"),
        joined_lines(F.col("lines_serving")).alias("lines"),
        is_multimodal(F.col("lines_serving")).alias("multimodal"),
        F.round(now, 1).alias("now_val"),
        F.round(past, 1).alias("hist_val"),
        F.round("_zs", 2).alias("z_stream"),
        F.round("_zb", 2).alias("z_hist"),
        "delta_z",
        F.col("event_count").alias("n_stream"),
        F.col("total_trips").alias("n_hist_trips"),
        F.date_format("window_end", "HH:mm:ss'Z'").alias("window_end"),
        delta_flag(F.col("delta_z")).alias("flag"),
    ).orderBy(F.desc("delta_z"), "station_id")


def zscore_context(current: DataFrame, history: DataFrame) -> DataFrame:
    """Network figures in one row: overlap, level and spread of each side on its own scale."""
    sides = match_sides(current, history)
    both = F.col("in_current") & F.col("in_history")
    mu_s, sigma_s = moments(F.when(both, F.col("avg_vehicle_occupancy")))
    mu_b, sigma_b = moments(F.when(both, F.col("avg_passengers")))
    return sides.agg(
        F.count_if(both).alias("n_common"),
        F.count_if(F.col("in_current") & ~F.col("in_history")).alias("n_only_stream"),
        F.count_if(~F.col("in_current") & F.col("in_history")).alias("n_only_hist"),
        F.round(mu_s, 1).alias("mu_stream"),
        F.round(sigma_s, 1).alias("sigma_stream"),
        F.round(mu_b, 1).alias("mu_batch"),
        F.round(sigma_b, 1).alias("sigma_batch"),
        (sigma_b < 1e-6).alias("sigma_b_zero"),
    )


def delta_counts(ranking: DataFrame) -> DataFrame:
    """How many stations rose, and how many fell or stayed."""
    rose = F.col("delta_z") > 0
    return ranking.agg(F.count_if(rose).alias("n_above"), F.count_if(~rose).alias("n_not_above"))


def rank_delta(ranking: DataFrame, top: int = 10, bottom: int = 5) -> DataFrame:
    """The strongest rises, and the strongest falls among stations that did fall."""
    rises = top_n(ranking, top, "delta_z", "station_id").withColumn("side", F.lit("top"))
    falls = ranking.filter("delta_z < 0").orderBy("delta_z", "station_id").limit(bottom)
    return rises.unionByName(falls.withColumn("side", F.lit("bottom")))
