"""Tumbling-window aggregates over events. The same functions run on streams and on tables.

Events outside a question are not filtered away before the aggregate: Spark would
move such a filter below the watermark, and then a quiet station's windows would
wait for its own next event instead of closing with the stream. Instead their key
and values are blanked, so they all combine into one empty row per window and task,
which is removed after aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.events import HIGH_DELAY_SECONDS, high_delay, service_type
from tidelake.functions.trips import audit_ts

WINDOW = "1 minute"
WATERMARK = "120 seconds"

MOVEMENTS = ["arrival", "departure"]
ALERTS = ["delay_alert", "capacity_alert"]

# A station has one name, so the name can be part of the key instead of an aggregate.
STATION_KEYS = ["station_id", "stop_name"]


def _in_scope(events: DataFrame, scope: Column, columns: list[str]) -> DataFrame:
    """Blank the named columns of events outside the scope."""
    matched = F.coalesce(scope, F.lit(False))
    return events.select(
        "event_time",
        matched.alias("_matched"),
        *[F.when(matched, F.col(c)).alias(c) for c in columns],
    )


def _windowed(events: DataFrame, window: str, keys: list[str], *aggregates: Column) -> DataFrame:
    grouped = events.groupBy(F.window("event_time", window).alias("_window"), *keys).agg(
        F.count_if("_matched").alias("_events"), *aggregates
    )
    return grouped.filter("_events > 0").withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    )


def _last(column: str) -> Column:
    """Value of the newest event, ties broken by event id."""
    return F.max_by(column, F.struct("event_time", "event_id")).alias(column)


def station_occupancy(enriched: DataFrame, window: str = WINDOW, as_of: Column | str | None = None) -> DataFrame:
    """Vehicle load per station and window, from arrivals and departures.

    Maximum and sum start at zero, so a window of negative loads reports a maximum of 0.
    """
    moves = _in_scope(
        enriched, F.col("event_type").isin(MOVEMENTS),
        [*STATION_KEYS, "line", "passenger_count"],
    )
    load = _windowed(
        moves, window, STATION_KEYS,
        F.array_sort(F.collect_set("line")).alias("lines_serving"),
        F.greatest(F.max("passenger_count"), F.lit(0)).alias("max_vehicle_occupancy"),
        F.round(F.avg("passenger_count"), 2).alias("avg_vehicle_occupancy"),
    )
    return _occupancy_rows(load, as_of)


def _occupancy_rows(load: DataFrame, as_of: Column | str | None) -> DataFrame:
    return load.select(
        "station_id", "stop_name", "lines_serving", "window_start", "window_end",
        "max_vehicle_occupancy", "avg_vehicle_occupancy",
        F.col("_events").alias("event_count"),
        audit_ts(as_of).alias("last_updated"),
    )


def line_delays(
    events: DataFrame, window: str = WINDOW, threshold: int = HIGH_DELAY_SECONDS, as_of: Column | str | None = None
) -> DataFrame:
    """Delay per line and window, from all events that report one; ``vehicles_seen`` counts events."""
    reports = _in_scope(events, F.col("delay_seconds") >= 0, ["line", "delay_seconds"])
    delays = _windowed(
        reports, window, ["line"],
        F.round(F.avg("delay_seconds"), 2).alias("avg_delay_seconds"),
        F.max("delay_seconds").alias("max_delay_seconds"),
        F.count_if(F.col("delay_seconds") > threshold).alias("vehicles_delayed"),
    )
    return _delay_rows(delays, threshold, as_of)


def _delay_rows(delays: DataFrame, threshold: int, as_of: Column | str | None) -> DataFrame:
    return delays.select(
        "line", service_type(F.col("line")).alias("tipo_servicio"), "window_start", "window_end",
        "avg_delay_seconds", "max_delay_seconds",
        F.col("_events").alias("vehicles_seen"), "vehicles_delayed",
        high_delay(F.col("max_delay_seconds"), threshold).alias("high_delay"),
        audit_ts(as_of).alias("last_updated"),
    )


def station_alerts(enriched: DataFrame, window: str = WINDOW) -> DataFrame:
    """Delay and capacity alerts per station and window."""
    alerts = _in_scope(
        enriched, F.col("event_type").isin(ALERTS), ["event_id", "event_type", *STATION_KEYS, "line"]
    )
    counts = _windowed(
        alerts, window, STATION_KEYS,
        _last("line"),
        F.count_if(F.col("event_type") == "delay_alert").alias("delay_alerts"),
        F.count_if(F.col("event_type") == "capacity_alert").alias("capacity_alerts"),
    )
    return _alert_rows(counts)


def _alert_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        "station_id", "stop_name", "line", "window_start", "window_end", "delay_alerts", "capacity_alerts",
        (F.col("delay_alerts") + F.col("capacity_alerts")).alias("total_alerts"),
    )


OCCUPANCY, DELAYS, STATION_ALERTS = "station_occupancy", "line_delays", "station_alerts"


def fan_out(enriched: DataFrame, window: str = WINDOW, threshold: int = HIGH_DELAY_SECONDS, only: list[str] | None = None) -> DataFrame:
    """The windows of all three tables from one pass: ``split`` takes the rows of one table out.

    Every event becomes a row for the table of its type (occupancy or alerts) and one for the delays, with the key and value that
    the table groups; one aggregate by (window, table, key) then serves all. An event outside a table's question keeps its row
    with nothing in it, as elsewhere here: such rows combine into one a window and task, and time moves on with them.
    """
    wanted = [OCCUPANCY, DELAYS, STATION_ALERTS] if only is None else only
    kind, at_station = F.col("event_type"), [F.col(c) for c in STATION_KEYS]

    def row(table: Column, key: Column, name: Column, value: Column) -> Column:
        table = F.when(table.isin(wanted), table)
        cells = {"key": key, "name": name, "line": F.col("line"), "value": value, "kind": kind, "event_id": F.col("event_id")}
        return F.struct(table.alias("table"), *[F.when(table.isNotNull(), c).alias(n) for n, c in cells.items()])

    moved, warned = kind.isin(MOVEMENTS), kind.isin(ALERTS)
    rows = []
    if {OCCUPANCY, STATION_ALERTS} & set(wanted):
        rows.append(row(F.when(moved, OCCUPANCY).when(warned, STATION_ALERTS), *at_station, F.when(moved, F.col("passenger_count"))))
    if DELAYS in wanted:
        rows.append(row(F.when(F.col("delay_seconds") >= 0, DELAYS), F.col("line"), F.lit(None).cast("string"), F.col("delay_seconds")))
    events = enriched.select("event_time", F.explode(F.array(*rows)).alias("_row")).select("event_time", "_row.*")
    table, value = F.col("table"), F.col("value")
    grouped = events.groupBy(F.window("event_time", window).alias("_window"), "table", "key", "name").agg(
        F.count(F.lit(1)).alias("_events"),
        F.array_sort(F.collect_set(F.when(table == OCCUPANCY, F.col("line")))).alias("lines"),
        F.max(value).alias("most"),
        F.round(F.avg(value), 2).alias("average"),
        F.count_if((table == DELAYS) & (value > threshold)).alias("delayed"),
        F.max_by(F.when(table == STATION_ALERTS, F.col("line")), F.struct("event_time", "event_id")).alias("line"),
        F.count_if((table == STATION_ALERTS) & (F.col("kind") == "delay_alert")).alias("delay_alerts"),
        F.count_if((table == STATION_ALERTS) & (F.col("kind") == "capacity_alert")).alias("capacity_alerts"),
    )
    named = {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    return grouped.filter(table.isNotNull()).withColumns(named).drop("_window")


def split(fanned: DataFrame, table: str, threshold: int = HIGH_DELAY_SECONDS, as_of: Column | str | None = None) -> DataFrame:
    """The rows of one table out of ``fan_out``, as ``station_occupancy``, ``line_delays`` or ``station_alerts`` give them."""
    rows = fanned.filter(F.col("table") == table)
    if table == DELAYS:
        found = rows.select(
            F.col("key").alias("line"), "window_start", "window_end", "_events", F.col("average").alias("avg_delay_seconds"),
            F.col("most").alias("max_delay_seconds"), F.col("delayed").alias("vehicles_delayed"),
        )
        return _delay_rows(found, threshold, as_of)
    rows = rows.withColumnsRenamed({"key": "station_id", "name": "stop_name"})
    if table == STATION_ALERTS:
        return _alert_rows(rows)
    return _occupancy_rows(
        rows.select(
            *STATION_KEYS, F.col("lines").alias("lines_serving"), "window_start", "window_end", "_events",
            F.greatest("most", F.lit(0)).alias("max_vehicle_occupancy"), F.col("average").alias("avg_vehicle_occupancy"),
        ), as_of,
    )


def newest_event(events: DataFrame) -> Column:
    """Time of the newest event, as a scalar subquery."""
    return events.agg(F.max("event_time")).scalar()


def closed_windows(aggregates: DataFrame, newest: Column, delay: str = WATERMARK) -> DataFrame:
    """Of a batch aggregate, the windows a stream that has seen ``newest`` would have closed."""
    return aggregates.filter(F.col("window_end") <= newest - F.expr(f"INTERVAL {delay}"))


def latest_per_key(aggregates: DataFrame, key: str, order: str = "window_end") -> DataFrame:
    """Newest row per key, combined inside every task before the shuffle."""
    newest = aggregates.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("_row"))
    return newest.select("_row.*")


def running_type_counts(events: DataFrame) -> DataFrame:
    """Events seen so far per type; on a stream write it in complete mode."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
