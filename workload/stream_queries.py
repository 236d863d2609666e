"""Stream queries, the operational questions on their results, and the comparison with history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelake import schemas
from tidelake.functions.events import event_time, iso_format, iso_ms, iso_parse
from tidelake.operators import checks
from tidelake.plans import integration, serving
from tidelake.session import scratch
from tidelake.sources import streams
from tidelake.streaming import alerts, jobs, sinks, store, windows
from tidelake.streaming.events import enrich_events, parse_events, timed_events
from tidelake.streaming.sinks import confirmation_log
from workload import adapters
from workload.batch_queries import volume, wall_clock

HOURLY = jobs.StreamSettings(window="1 hour", trigger={"availableNow": True})
DAY = 86400


def _catalog(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return adapters.stops(spark, sf), adapters.stations(spark, sf)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return timed_events(adapters.messages(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_events(_events(spark, sf), *_catalog(spark, sf))


def _newest(spark: SparkSession, sf: str) -> Column:
    """The instant of the newest event, standing in for "now". Messages carry the time of their row."""
    newest = F.date_trunc("MILLISECOND", F.max(F.col("ts").cast("timestamp")))
    return adapters.table(spark, sf, "events").agg(newest).scalar()


def _closed(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    return windows.closed_windows(rows, _newest(spark, sf))


def _occupancy(spark: SparkSession, sf: str) -> DataFrame:
    """Latest closed hour per station, computed on the table."""
    hours = windows.station_occupancy(_enriched(spark, sf), "1 hour")
    return windows.latest_per_key(_closed(spark, sf, hours), "station_id")


def _delays(spark: SparkSession, sf: str) -> DataFrame:
    return windows.latest_per_key(_closed(spark, sf, windows.line_delays(_events(spark, sf), "1 hour")), "line")


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _closed(spark, sf, windows.station_alerts(_enriched(spark, sf), "10 minutes"))


def _volume(spark: SparkSession, sf: str) -> DataFrame:
    return volume(spark, sf)


# -- message bodies ---------------------------------------------------------


def event_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    """All messages, typed and timed, invalid ones included."""
    parsed = parse_events(adapters.messages(spark, sf))
    timed = parsed.withColumn("event_time", event_time(F.col("timestamp"), F.col("source_ts")))
    return wall_clock(timed.drop("source_ts"))


def event_json_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Messages damaged in ways that depend on their number ``k``, then parsed."""
    events = adapters.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    whole = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.col("event_type"),
        k.alias("passenger_count"), F.col("value").alias("delay_seconds"),
    ))
    body = (
        F.when(k < 10, F.lit("not json"))
        .when(k < 20, F.lit("[1, 2]"))
        .when(k < 30, F.format_string('{"event_id": "%s", "event_type": "click", "passenger_count": null}', "event_id"))
        .when(k < 40, F.format_string('{"event_id": "%s", "event_type": "click", "passenger_count": "%d"}', "event_id", k))
        .when(k < 50, F.format_string('{"event_id": "%s", "event_type": "click", "passenger_count": "3.7"}', "event_id"))
        .when(k < 60, F.format_string('{"event_id": "%s", "passenger_count": true}', "event_id"))
        .otherwise(whole)
    )
    parsed = parse_events(events.select(body.alias("value"), F.col("ts").cast("timestamp").alias("timestamp")))
    timed = parsed.withColumn("event_time", event_time(F.col("timestamp"), F.col("source_ts")))
    return wall_clock(timed.drop("source_ts"))


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times to text and back."""
    ts = F.col("ts").cast("timestamp")
    rows = adapters.table(spark, sf, "events").select(
        "event_id", iso_format(ts).alias("iso"), iso_ms(ts).alias("iso_ms"), iso_parse(iso_format(ts)).alias("parsed")
    )
    return wall_clock(rows)


# -- streams ----------------------------------------------------------------


def _run_history(spark: SparkSession, sf: str, name: str, schema: StructType) -> DataFrame:
    """Run the operational query over the event stream to its end and return every window that it closed in one table."""
    root = scratch(spark, name)
    for query in jobs.start_all(adapters.message_stream(spark, sf), *_catalog(spark, sf), root, HOURLY):
        query.awaitTermination()
    return wall_clock(sinks.history(spark, f"{root}/{name}", schema))


def occupancy_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = _run_history(spark, sf, "station_occupancy", schemas.STATION_OCCUPANCY)
    return rows.withColumn("lines_serving", F.array_join("lines_serving", ","))


def delay_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _run_history(spark, sf, "line_delays", schemas.LINE_DELAYS)


def alert_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _run_history(spark, sf, "station_alerts", schemas.STATION_ALERTS)


def occupancy_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Current occupancy as the stream job leaves it."""
    root = scratch(spark, "latest")
    for query in jobs.start_all(
        adapters.message_stream(spark, sf), *_catalog(spark, sf), root, HOURLY, only=["station_occupancy"]
    ):
        query.awaitTermination()
    rows = wall_clock(jobs.operational_table(spark, root, "station_occupancy"))
    return rows.withColumn("lines_serving", F.array_join("lines_serving", ","))


def event_type_running_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per type kept by a complete-mode stream."""
    root = scratch(spark, "counts")
    counts = windows.running_type_counts(timed_events(adapters.message_stream(spark, sf)))
    query = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{root}/counts"))
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/counts")


def delay_edge_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(alerts.delay_edge_alerts(_events(spark, sf), adapters.stops(spark, sf), slice_by="DAY"))


def _run_edges(spark: SparkSession, messages: DataFrame, sf: str, root: str) -> None:
    """Read a stream of messages to its present end, carrying open runs from batch to batch."""
    stops = adapters.stops(spark, sf)
    alerts.start_edge_alerts(messages, stops, root, {"availableNow": True}, slice_by="DAY", ttl=None).awaitTermination()


def delay_edge_alerts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``delay_edge_alerts`` from messages that arrive as files in three parts of time, the job restarted for each."""
    root = scratch(spark, "edge")
    messages = adapters.messages(spark, sf)
    days = adapters.table(spark, sf, "events").agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("b")).first()
    step = (days.b - days.a) / 3
    bounds = [None, days.a + step, days.a + 2 * step, None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        after = F.lit(True) if low is None else F.col("timestamp") >= F.lit(low)
        before = F.lit(True) if high is None else F.col("timestamp") < F.lit(high)
        messages.filter(after & before).write.mode("append").json(f"{root}/in")
        _run_edges(spark, streams.file_stream(spark, f"{root}/in"), sf, root)
    return wall_clock(alerts.vehicle_alerts(spark, root))


def delay_edge_alerts_carried(spark: SparkSession, sf: str) -> DataFrame:
    """``delay_edge_alerts`` from one large micro-batch."""
    root = scratch(spark, "carried")
    _run_edges(spark, adapters.message_stream(spark, sf), sf, root)
    return wall_clock(alerts.vehicle_alerts(spark, root))


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the operational query dropped, as its listener adds them up: the newer half of the messages comes first.

    The job is started again for each part, so that a part is one batch in as many files and tasks as it needs. A batch drops by the
    watermark after the run before it; the newest hundredth comes last. What meets the state are the distinct groups of a batch.
    """
    root, messages = scratch(spark, "late"), adapters.messages(spark, sf)
    at = F.unix_micros("timestamp")
    first, last = messages.agg(F.min(at), F.max(at)).first()
    half, end = (first + last) // 2, last - (last - first) // 100
    listener = jobs.LateRows(spark, f"{root}/late_rows")
    spark.streams.addListener(listener)
    try:
        for part in ((at >= half) & (at < end), at < half, at >= end):
            messages.filter(part).write.mode("append").json(f"{root}/in")
            queries = jobs.start_all(streams.file_stream(spark, f"{root}/in"), *_catalog(spark, sf), root, HOURLY)
            jobs.await_all(queries)
            listener.await_ended(queries)
    finally:
        spark.streams.removeListener(listener)
    return jobs.late_rows(spark, f"{root}/late_rows")


def message_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Events published as keyed JSON bodies by a stream of files, and read back."""
    root = scratch(spark, "published")
    adapters.messages(spark, sf).write.json(f"{root}/in")
    events = timed_events(streams.file_stream(spark, f"{root}/in")).select("event_id", "line", "passenger_count")
    streams.publish_stream(events, "text", f"{root}/checkpoint", path=f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.text(f"{root}/out")


def capacity_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(alerts.capacity_alerts(_events(spark, sf)).drop("timestamp"))


# -- operational questions --------------------------------------------------


def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = wall_clock(serving.occupancy_of(_occupancy(spark, sf), "EST-11"))
    return found.withColumn("lines_serving", F.array_join("lines_serving", ","))


def station_state(spark: SparkSession, sf: str) -> DataFrame:
    """``point_lookup`` on the table that the stream has written: its batches merged and clustered, then read by key."""
    root = scratch(spark, "lookup")
    for query in jobs.start_all(adapters.message_stream(spark, sf), *_catalog(spark, sf), root, HOURLY, only=["station_occupancy"]):
        query.awaitTermination()
    store.merge(spark, f"{root}/station_occupancy", schemas.STATION_OCCUPANCY, "station_id")
    found = wall_clock(jobs.station_state(spark, root, "EST-11"))
    return found.withColumn("lines_serving", F.array_join("lines_serving", ","))


def top_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    ranked = wall_clock(serving.top_occupancy(_occupancy(spark, sf)))
    return ranked.withColumn("lines_serving", F.array_join("lines_serving", ","))


def critical_lines(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(serving.critical_lines(_delays(spark, sf)))


def alert_history_day(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(serving.alert_rollup(_alerts(spark, sf), _newest(spark, sf), seconds=DAY))


def alert_history_station(spark: SparkSession, sf: str) -> DataFrame:
    return wall_clock(serving.alert_rollup(_alerts(spark, sf), _newest(spark, sf), "EST-11", seconds=DAY))


def alert_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_alerts(serving.alert_rollup(_alerts(spark, sf), _newest(spark, sf), seconds=DAY))


TTL = {"station_occupancy": ("window_end", 2 * DAY), "line_delays": ("window_end", 3 * 3600), "station_alerts": ("window_end", DAY)}


def ttl_retention(spark: SparkSession, sf: str) -> DataFrame:
    """Alert windows that have not expired a day after their end."""
    return wall_clock(sinks.alive(_alerts(spark, sf), "station_alerts", _newest(spark, sf), TTL))


def ttl_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each operational table under its own limit, before and after."""
    now = _newest(spark, sf)
    counts = []
    for name, rows in (("station_occupancy", _occupancy(spark, sf)), ("line_delays", _delays(spark, sf)), ("station_alerts", _alerts(spark, sf))):
        for state, kept in (("all", rows), ("alive", sinks.alive(rows, name, now, TTL))):
            counts.append(kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), F.lit(state).alias("state"), "n"))
    return checks.report(counts)


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Newest window of each operational table against the newest event."""
    now = _newest(spark, sf)
    alerts_found = checks.check_exists(_alerts(spark, sf), "window_end", "station_alerts").drop("n")
    return wall_clock(
        checks.report(
            [
                checks.check_fresh(_occupancy(spark, sf), "window_end", 3600 + 120, now, "station_occupancy"),
                checks.check_fresh(_delays(spark, sf), "window_end", 60, now, "line_delays"),
                alerts_found,
            ]
        )
    )


def document_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Warnings about rows of the enriched stream without a known station name."""
    found = _enriched(spark, sf).withColumn(
        "stop_name", F.when(F.col("stop_name") != F.col("stop_id"), F.col("stop_name"))
    )
    rules = {"required": ["stop_name", "line"], "types": {"passenger_count": ("bigint",), "line": ("string",)}}
    return checks.validate_schema(found, rules)


def confirmation_lines(spark: SparkSession, sf: str) -> DataFrame:
    return confirmation_log(_alerts(spark, sf))


# -- comparison with history ------------------------------------------------


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    now = _newest(spark, sf)
    return (
        integration.current_readings(_occupancy(spark, sf), now, seconds=DAY),
        integration.history_slot(_volume(spark, sf), now),
    )


def zscore_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return integration.zscore_ranking(*_sides(spark, sf))


def zscore_context(spark: SparkSession, sf: str) -> DataFrame:
    return integration.zscore_context(*_sides(spark, sf))


def zscore_extremes(spark: SparkSession, sf: str) -> DataFrame:
    ranking = integration.zscore_ranking(*_sides(spark, sf))
    return integration.rank_delta(ranking).select("side", "station_id", "delta_z")


def zscore_counts(spark: SparkSession, sf: str) -> DataFrame:
    return integration.delta_counts(integration.zscore_ranking(*_sides(spark, sf)))


def matched_sides(spark: SparkSession, sf: str) -> DataFrame:
    return integration.match_sides(*_sides(spark, sf)).select("station_id", "in_current", "in_history")


QUERIES = {
    f.__name__: f
    for f in [
        event_json_parse, event_json_damaged, event_times, occupancy_stream, delay_stream, alert_stream,
        occupancy_latest, event_type_running_counts, delay_edge_alerts, delay_edge_alerts_stream,
        delay_edge_alerts_carried, capacity_alerts, late_rows,
        point_lookup, station_state, top_occupancy, critical_lines, alert_history_day, alert_history_station, alert_ranking,
        ttl_retention, ttl_all_tables, message_bodies, freshness, document_rules, confirmation_lines, zscore_ranking, zscore_context,
        zscore_extremes, zscore_counts, matched_sides,
    ]
}
