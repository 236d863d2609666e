"""Alerts raised from movements: accumulated delay per vehicle, and full vehicles."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake.functions.events import FULL_SHARE, HIGH_DELAY_SECONDS, capacity_of, service_type
from tidelake.operators.dimensions import terminal_stops
from tidelake.operators.runs import running_sum_with_resets
from tidelake.operators.sizing import broadcast_if_small
from tidelake.schemas import struct
from tidelake.sources.refreshed import files_of
from tidelake.streaming import store
from tidelake.streaming.events import timed_events
from tidelake.streaming.sinks import BatchWriter, batch_key, every

ALERT_COLUMNS = ["vehicle_id", "line", "stop_id", "event_id", "event_time", "accumulated_delay"]
ALERT_SCHEMA = (
    "vehicle_id string, line string, stop_id string, event_id string, event_time timestamp, accumulated_delay bigint"
)


#: Copies of the terminal list over which a stop's movements are spread where the list is too large to broadcast.
SALTS = 16


def mark_terminals(events: DataFrame, stops: DataFrame, salts: int = SALTS) -> DataFrame:
    """Arrivals and departures of known vehicles, with ``at_terminal`` for arrivals at the first or last stop of a line.

    Events without a vehicle id belong to no vehicle's sum and are left out; ``without_vehicle`` counts them. A stop that ends
    several lines is one terminal.
    """
    ends = terminal_stops(stops).select(F.col("stop_id").alias("_terminal")).distinct()
    moves = events.filter(F.col("event_type").isin("arrival", "departure") & _has_vehicle())
    small = broadcast_if_small(ends)
    match = F.col("stop_id") == F.col("_terminal")
    if small is ends and salts > 1:
        moves = moves.withColumn("_salt", F.pmod(F.xxhash64("event_id", "vehicle_id", "event_time"), F.lit(salts)))
        small = ends.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        match = match & (F.col("_salt") == F.col("_copy"))
    marked = moves.join(small, match, "left")
    arrived = (F.col("event_type") == "arrival") & F.col("_terminal").isNotNull()
    return marked.withColumn("at_terminal", arrived).drop("_terminal", "_salt", "_copy")


def _has_vehicle() -> Column:
    return F.coalesce(F.col("vehicle_id") != "", F.lit(False))


def without_vehicle(events: DataFrame) -> DataFrame:
    """How many movements name no vehicle."""
    moves = events.filter(F.col("event_type").isin("arrival", "departure"))
    return moves.agg(F.count_if(~_has_vehicle()).alias("without_vehicle"))


def _segment_delay() -> Column:
    return F.when(F.col("event_type") == "departure", F.col("delay_seconds")).otherwise(0).cast("long")


#: What the sums and the alerts need of a movement; nothing else is shuffled.
MOVE_COLUMNS = ["vehicle_id", "event_time", "event_id", "event_type", "line", "stop_id", "delay_seconds", "at_terminal"]


def _sum_runs(moves: DataFrame, slice_by: str, *further: str) -> DataFrame:
    return running_sum_with_resets(
        moves.select(*MOVE_COLUMNS, *further),
        "vehicle_id",
        ["event_time", "event_id"],
        _segment_delay(),
        F.col("at_terminal"),
        F.date_trunc(slice_by, "event_time"),
    )


def _first_crossings(summed: DataFrame, threshold: int) -> DataFrame:
    """Per vehicle and run, the departure at which the sum first exceeds the threshold."""
    over = summed.filter((F.col("running") > threshold) & (F.col("event_type") == "departure"))
    first = over.groupBy("vehicle_id", "run").agg(
        F.min_by(
            F.struct("line", "stop_id", "event_id", "event_time", F.col("running").alias("accumulated_delay")),
            F.struct("event_time", "event_id"),
        ).alias("_first")
    )
    return first.select("vehicle_id", "run", "_first.*")


def delay_edge_alerts(
    events: DataFrame, stops: DataFrame, threshold: int = HIGH_DELAY_SECONDS, slice_by: str = "HOUR"
) -> DataFrame:
    """One alert per vehicle run, at the departure where its accumulated delay first exceeds the threshold.

    A run ends with the arrival at a terminal. ``slice_by`` is the time unit a
    vehicle's history is cut into for parallel work; it does not change results.
    """
    summed = _sum_runs(mark_terminals(events, stops), slice_by)
    return _first_crossings(summed, threshold).select(*ALERT_COLUMNS)


RUN_STATE = struct("vehicle_id string, accumulated bigint, alerted boolean, seen timestamp")
ALERTS = struct(ALERT_SCHEMA)

# Sorts before any event, so that the carried delay opens its vehicle's sum.
_OPENING_TIME = "0001-01-01 00:00:00"
_SNAPSHOT = re.compile(r"after=([0-9]+)")


def carry_runs(summed: DataFrame, state: DataFrame, threshold: int, ttl: str | None) -> tuple[DataFrame, DataFrame]:
    """Alerts of one micro-batch, and the open runs of all vehicles after it.

    ``summed`` holds the moves of the batch and one opening row for each open run of ``state``, so vehicles without a move are in it
    too. A run is open as long as it has a delay or has alerted, and its last move is less than ``ttl`` older than the newest.
    """
    crossings = _first_crossings(summed, threshold)
    warned = state.filter("alerted").select(F.col("vehicle_id").alias("_warned"))
    resumed = (F.col("vehicle_id") == F.col("_warned")) & (F.col("run") == 0)
    fired = crossings.join(warned, resumed, "left_anti").select(*ALERT_COLUMNS)

    last = F.struct("event_time", "event_id")
    moved = F.max(F.when(F.col("event_id") != "", F.col("event_time")))
    ends = summed.groupBy("vehicle_id").agg(
        F.max_by(F.struct("run", "running", "at_terminal"), last).alias("_end"),
        F.greatest(moved, F.max("seen")).alias("seen"),
        F.max(F.when(F.col("running") > threshold, F.col("run"))).alias("_crossed"),
    )
    ends = ends.select("vehicle_id", "seen", "_crossed", "_end.*").join(warned, resumed, "left")
    closed, crossed = F.col("at_terminal"), F.col("_crossed").eqNullSafe(F.col("run"))
    after = ends.select(
        "vehicle_id",
        F.when(closed, 0).otherwise(F.col("running")).cast("bigint").alias("accumulated"),
        (~closed & (crossed | F.col("_warned").isNotNull())).alias("alerted"),
        "seen",
    ).filter("accumulated <> 0 OR alerted")
    if ttl:
        newest = summed.agg(F.max("event_time").alias("t")).select(F.col("t")).scalar()
        after = after.filter(F.col("seen") > newest - F.expr(f"INTERVAL {ttl}"))
    return fired, after


def _snapshots(spark: SparkSession, state: str) -> list[int]:
    """Numbers of the micro-batches after which the state was kept as a whole, ascending."""
    store, root = files_of(spark, state)
    if not store.exists(root):
        return []
    found = [m for status in store.listStatus(root) if (m := _SNAPSHOT.fullmatch(status.getPath().getName()))]
    return sorted(int(m[1]) for m in found if store.exists(files_of(spark, f"{state}/{m[0]}/_SUCCESS")[1]))


def open_runs(spark: SparkSession, state: str, before: int | None = None) -> DataFrame:
    """The open runs after the newest micro-batch (before that number)."""
    kept = [n for n in _snapshots(spark, state) if before is None or n < before]
    return spark.read.schema(RUN_STATE).parquet(f"{state}/after={kept[-1]}") if kept else spark.createDataFrame([], RUN_STATE)


def edge_alert_writer(
    state: str, alerts: str, threshold: int = HIGH_DELAY_SECONDS, slice_by: str = "HOUR", ttl: str | None = None,
    key: Callable[[DataFrame, int], str] = batch_key,
) -> BatchWriter:
    """``foreachBatch`` writer over ``mark_terminals`` rows that carries each vehicle's open run from batch to batch.

    The sums are the sliced ones of the batch version: a vehicle that dominates a micro-batch is worked on by many
    tasks. The state is a snapshot of all open runs, so a batch reads one and writes one however many came before, and runs that
    have ended or expired leave it. A batch reads the snapshot before its own number and writes alerts and snapshot under its
    key, so a replay after any failure completes the pair with the same rows. Snapshots are those of one checkpoint: ``state``
    belongs to it. Two are kept.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, key(batch, batch_id)
        before = open_runs(spark, state, batch_id)
        opening = before.select(
            "vehicle_id", F.lit(_OPENING_TIME).cast("timestamp").alias("event_time"), F.lit("").alias("event_id"),
            F.lit("departure").alias("event_type"), F.lit(None).cast("string").alias("line"),
            F.lit(None).cast("string").alias("stop_id"), F.col("accumulated").alias("delay_seconds"),
            F.lit(False).alias("at_terminal"), "seen",
        )
        moves = batch.select(*MOVE_COLUMNS, F.lit(None).cast("timestamp").alias("seen"))
        summed = _sum_runs(moves.unionByName(opening), slice_by, "seen")
        summed.persist()
        try:
            fired, after = carry_runs(summed, before, threshold, ttl)
            store.put(fired, alerts, name)
            # State is small beside the batch; a few files keep the next read short.
            after.coalesce(4).write.mode("overwrite").parquet(f"{state}/after={batch_id}")
        finally:
            summed.unpersist()
        for old in [n for n in _snapshots(spark, state) if n <= batch_id][:-2]:
            files, folder = files_of(spark, f"{state}/after={old}")
            files.delete(folder, True)

    return sink


def start_edge_alerts(
    raw: DataFrame, stops: DataFrame, root: str, trigger: dict | None = None, slice_by: str = "HOUR", ttl: str | None = "24 hours",
    merge_every: int = 0, threshold: int = HIGH_DELAY_SECONDS,
) -> StreamingQuery:
    """Run the vehicle alerts over a stream of messages: alerts in ``root``/vehicle_alerts, open runs in ``root``/vehicle_runs."""
    moves = mark_terminals(timed_events(raw), stops)
    alerts = f"{root}/vehicle_alerts"
    writer = edge_alert_writer(f"{root}/vehicle_runs", alerts, threshold, slice_by, ttl)
    if merge_every:
        writer = every(writer, merge_every, lambda spark: store.merge(spark, alerts, ALERTS, "vehicle_id"))
    stream = moves.writeStream.queryName("vehicle_alerts").option("checkpointLocation", f"{root}/checkpoint/vehicle_alerts")
    stream = stream.foreachBatch(writer)
    return (stream.trigger(**trigger) if trigger else stream).start()


def vehicle_alerts(spark: SparkSession, root: str) -> DataFrame:
    """Every alert that ``start_edge_alerts`` has raised."""
    return store.rows(spark, f"{root}/vehicle_alerts", ALERTS)


def capacity_alerts(events: DataFrame, share: float = FULL_SHARE) -> DataFrame:
    """Arrivals whose load exceeds a share of what a vehicle of their line's service can hold."""
    places = capacity_of(service_type(F.col("line")))
    # Compared in thousandths of a place, so that exactly the share does not alert.
    full = F.col("passenger_count") * 1000 > places * round(share * 1000)
    return events.filter((F.col("event_type") == "arrival") & full).withColumn("capacity", places)
