"""Aggregate tables that follow new batches: mergeable states per batch, merged when they are read.

A batch of raw trips is cleaned into its own partition, and of that partition alone the states are made: sums, counts and maxima,
value counts, and two sketches. They are written under the batch's key, so a batch that is loaded again replaces what it
gave before, in whatever order batches come. Reading merges all states, whose number grows with groups and batches but
not with trips. A change of the catalog concerns every batch: then all of them are updated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.plans import gold
from tidelake.plans.silver import build_silver
from tidelake.schemas import struct
from tidelake.sources import tables


@dataclass(frozen=True)
class Kept:
    """One aggregate table: the schema of its states, how a batch of clean trips gives them, and how they merge."""

    schema: str
    of_batch: Callable[[DataFrame], DataFrame]
    merged: Callable[[DataFrame, Column | str | None], DataFrame]


_NUMBERS = {"trips": F.sum, "passengers": F.sum, "counted": F.sum, "most": F.max, "delay": F.sum, "delayed": F.sum}


def _volume_states(silver: DataFrame) -> DataFrame:
    load, delay = F.col("passenger_count"), F.col("delay_seconds")
    return silver.groupBy(*gold.slot_columns()).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(load).alias("passengers"), F.count(load).alias("counted"),
        F.max(load).alias("most"), F.sum(delay).alias("delay"), F.count(delay).alias("delayed"),
    )


def _ratio(total: str, number: str, digits: int = 2) -> Column:
    """An average from its parts; NULL where nothing was counted."""
    return F.round(F.try_divide(F.col(total), F.col(number)), digits)


def _volume(states: DataFrame, as_of: Column | str | None) -> DataFrame:
    slots = states.groupBy(*gold.SLOT).agg(*[merge(c).alias(c) for c, merge in _NUMBERS.items()])
    volume = slots.select(
        *gold.SLOT, F.col("passengers").alias("total_passengers"), F.col("most").alias("max_passengers"),
        _ratio("passengers", "counted").alias("avg_passengers"), _ratio("delay", "delayed").alias("avg_delay_seconds"),
        F.col("trips").alias("total_trips"),
    )
    return gold.label_volume(volume, as_of)


def _delay_states(silver: DataFrame) -> DataFrame:
    delay, parts = F.col("delay_seconds"), []
    for name, counts in gold.delay_splits():
        value = delay if counts is None else F.when(counts, delay)
        parts += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    totals = [F.count(F.lit(1)).alias("total_trips"), F.count_if("is_holiday").alias("total_holiday_trips")]
    return silver.groupBy(*gold.month_columns()).agg(*totals, *parts)


def _delays(states: DataFrame, as_of: Column | str | None) -> DataFrame:
    names = [name for name, _ in gold.delay_splits()]
    summed = ["total_trips", "total_holiday_trips", *(f"{name}_{part}" for name in names for part in ("sum", "n"))]
    months = states.groupBy(*gold.MONTH).agg(*[F.sum(c).alias(c) for c in summed])
    return gold.label_delays(months.withColumns({name: _ratio(f"{name}_sum", f"{name}_n") for name in names}), as_of)


def _demand_states(silver: DataFrame) -> DataFrame:
    return gold.demand_counts(silver)


def _demand(states: DataFrame, as_of: Column | str | None) -> DataFrame:
    counts = states.groupBy(*gold.DEMAND, "passenger_count").agg(F.sum("n").alias("n"))
    return gold.demand_from_counts(counts, as_of=as_of)


#: Rank error of a sketch of k = 200 values with 99 % confidence (one-sided), and bits of a distinct-count sketch: its standard
#: error is about 1.04 / sqrt(2 ** bits), 0.8 %.
SKETCH_K, DISTINCT_BITS = 200, 14


def _spread_states(silver: DataFrame) -> DataFrame:
    return silver.groupBy("line").agg(
        F.count(F.lit(1)).alias("trips"),
        F.kll_sketch_agg_bigint(F.col("passenger_count").cast("bigint"), F.lit(SKETCH_K)).alias("loads"),
        F.hll_sketch_agg("stop_id_origen", F.lit(DISTINCT_BITS)).alias("origins"),
        F.hll_sketch_agg("trip_id", F.lit(DISTINCT_BITS)).alias("trip_ids"),
    )


def _spread(states: DataFrame, as_of: Column | str | None) -> DataFrame:
    merged = states.groupBy("line").agg(
        F.sum("trips").alias("trips"), F.kll_merge_agg_bigint("loads").alias("loads"),
        F.hll_union_agg("origins").alias("origins"), F.hll_union_agg("trip_ids").alias("trip_ids"),
    )
    return merged.select(
        "line", "trips", F.kll_sketch_get_quantile_bigint("loads", F.lit(gold.HIGH_DEMAND_QUANTILE)).alias("p90_about"),
        F.hll_sketch_estimate("origins").alias("origins_about"), F.hll_sketch_estimate("trip_ids").alias("trip_ids_about"),
    )


_SLOT = "station_id string, nombre_estacion string, municipio string, hour_block string, time_of_day string, day_of_week_num int"
_DELAY_PARTS = ", ".join(f"{name}_{part} bigint" for name, _ in gold.DELAY_SPLITS for part in ("sum", "n"))

#: The aggregate tables by name. The last one holds sketches: for thresholds and distinct counts over values or keys too many
#: to be counted one by one.
TABLES: dict[str, Kept] = {
    "estaciones_volumen": Kept(f"{_SLOT}, trips bigint, passengers bigint, counted bigint, most int, delay bigint, delayed bigint", _volume_states, _volume),
    "retraso_por_linea_mes": Kept(f"line string, tipo_servicio string, year int, month int, total_trips bigint, total_holiday_trips bigint, {_DELAY_PARTS}", _delay_states, _delays),
    "demanda_rutas": Kept("line string, tipo_servicio string, hour_block string, time_of_day string, passenger_count int, n bigint", _demand_states, _demand),
    "lineas_aproximado": Kept("line string, trips bigint, loads binary, origins binary, trip_ids binary", _spread_states, _spread),
}


def one_batch(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The rows of one batch: its partition, no other file is opened."""
    return tables.read(spark, path, merge=False).filter(F.col(tables.BATCH) == key).drop(tables.BATCH)


def update_batch(bronze: DataFrame, dim: DataFrame, key: str, clean: str, states: str, as_of: Column | str | None = None) -> None:
    """Clean the raw trips of one batch into their partition of ``clean``, and replace the states of that batch."""
    spark = bronze.sparkSession
    tables.put_batch(build_silver(bronze, dim, as_of), clean, key)
    rows = one_batch(spark, clean, key)
    for name, kept in TABLES.items():
        tables.put_batch(kept.of_batch(rows), f"{states}/{name}", key)


def merged_table(spark: SparkSession, states: str, name: str, as_of: Column | str | None = None) -> DataFrame:
    """An aggregate table as of all batches seen so far; empty before the first."""
    kept = TABLES[name]
    rows = tables.read(spark, f"{states}/{name}", tables.batched(struct(kept.schema)))
    return kept.merged(rows.drop(tables.BATCH), as_of)


def behind(spark: SparkSession, bronze: str, states: str) -> list[str]:
    """Keys of loaded batches that have no states yet; only partition names and file footers are read."""
    loaded = tables.batch_keys(spark, bronze)
    return sorted(loaded - set.intersection(*(tables.batch_keys(spark, f"{states}/{name}") for name in TABLES)))
