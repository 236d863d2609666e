"""The operational tables, kept by one query over the event stream."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidelake import schemas
from tidelake.streaming import sinks, store, windows
from tidelake.streaming.events import enrich_events, timed_events
from tidelake.streaming.sinks import BatchWriter, with_log


@dataclass(frozen=True)
class StreamSettings:
    window: str = windows.WINDOW
    delay: str = windows.WATERMARK
    trigger: dict | None = None  # e.g. {"availableNow": True}; None means as fast as possible
    salts: int = 16
    log: bool = False
    merge_every: int = 0  # micro-batches between merges of the tables by the stream itself; 0: ``clean`` does it


#: The operational tables: schema, key, and whether only the newest window of a key is its current state (else a history).
OPERATIONAL = {
    windows.OCCUPANCY: (schemas.STATION_OCCUPANCY, "station_id", True),
    windows.DELAYS: (schemas.LINE_DELAYS, "line", True),
    windows.STATION_ALERTS: (schemas.STATION_ALERTS, "station_id", False),
}


def operational_table(spark: SparkSession, root: str, name: str, as_of: Column | str | None = None) -> DataFrame:
    """Current occupancy by station, current delays by line, or the alert history; with ``as_of`` without expired rows.

    A table that no stream has written yet is empty; reading never creates one.
    """
    schema, key, newest = OPERATIONAL[name]
    rows = sinks.history(spark, f"{root}/{name}", schema)
    rows = rows if as_of is None else sinks.alive(rows, name, as_of)
    return sinks.latest(rows, key) if newest else rows


def station_state(spark: SparkSession, root: str, station_id: str, as_of: Column | str | None = None) -> DataFrame:
    """Current occupancy of one station, read by its key: one folder of the base, and the batches since its last merge."""
    schema, key, _ = OPERATIONAL[windows.OCCUPANCY]
    rows = store.lookup(spark, f"{root}/{windows.OCCUPANCY}", schema, key, station_id)
    return sinks.latest(rows if as_of is None else sinks.alive(rows, windows.OCCUPANCY, as_of), key)


def operational_tables(spark: SparkSession, root: str, as_of: Column | str | None = None) -> dict[str, DataFrame]:
    return {name: operational_table(spark, root, name, as_of) for name in OPERATIONAL}


def purge_all(spark: SparkSession, root: str, as_of: Column | str) -> None:
    """Merge the micro-batches of every table and its log, and leave behind what has expired. It may run beside the stream."""
    for name, (schema, key, _) in OPERATIONAL.items():
        sinks.purge(spark, f"{root}/{name}", schema, name, key, as_of)
        sinks.purge(spark, f"{root}/log/{name}", sinks.LOG, "log", "value", as_of, sinks.LOG_RETENTION)
    store.merge(spark, f"{root}/late_rows", schemas.struct(LATE), "query", folders=1)


#: Name of the query, and so of its checkpoint.
JOB = "operational"


def start_window_query(
    rows: DataFrame, name: str, writer: BatchWriter, root: str, settings: StreamSettings
) -> StreamingQuery:
    """Run a windowed aggregate: each window is handed over once, when the watermark passes its end."""
    if settings.log:
        writer = with_log(writer, f"{root}/log/{name}")
    stream = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint/{name}")
        .foreachBatch(writer)
    )
    if settings.trigger:
        stream = stream.trigger(**settings.trigger)
    return stream.start()


def start_all(
    raw: DataFrame,
    stops: DataFrame,
    stations: DataFrame,
    root: str,
    settings: StreamSettings = StreamSettings(),
    only: list[str] | None = None,
) -> list[StreamingQuery]:
    """Start the query that keeps the occupancy, delay and alert tables (or some of them) below ``root``.

    The source is read, parsed and enriched once for all tables, and their windows lie in one state.
    """
    names = [name for name in OPERATIONAL if only is None or name in only]
    enriched = enrich_events(timed_events(raw, settings.delay), stops, stations, settings.salts)
    fanned = windows.fan_out(enriched, settings.window, only=names)

    def written(name: str) -> BatchWriter:
        writer = sinks.window_writer(f"{root}/{name}")
        return with_log(writer, f"{root}/log/{name}") if settings.log else writer

    writer = sinks.fan_out_writer(windows.split, {name: written(name) for name in names})
    if settings.merge_every:
        writer = sinks.every(writer, settings.merge_every, lambda spark: purge_all(spark, root, F.current_timestamp()))
    return [start_window_query(fanned, JOB, writer, root, StreamSettings(trigger=settings.trigger))]


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended. If one fails, stop the others and fail with its error."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    failed = None
    while failed is None and any(q.isActive for q in queries):
        for query in queries:
            if query.isActive and query.awaitTermination(1):
                spark.streams.resetTerminated()
        failed = next((q.exception() for q in queries if not q.isActive and q.exception()), None)
    failed = failed or next((q.exception() for q in queries if q.exception()), None)
    if failed:
        for query in queries:
            query.stop()
        raise failed


LATE = "run_id string, query string, batch_id bigint, dropped bigint"


class LateRows(StreamingQueryListener):
    """Adds the rows that each batch dropped because their window was closed: one row a batch in a table of their own.
    What is counted is what meets the state: the events of one table, window and key in a task count once.

    Progress records are bounded in a query's memory, so a sum over those would forget; the table does not.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if dropped:
            row = [(str(progress.runId), progress.name, progress.batchId, dropped)]
            store.put(self.spark.createDataFrame(row, LATE), self.path, f"{progress.id}-{progress.batchId}")

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def await_ended(self, queries: list[StreamingQuery], seconds: float = 600) -> None:
        """Wait until every batch of the queries that have ended is counted: a query's events come in order, its end last."""
        until = time.monotonic() + seconds
        while missing := [q for q in queries if not q.isActive and str(q.runId) not in self.ended]:
            if time.monotonic() > until:
                raise TimeoutError(f"late rows of {[q.name for q in missing]} may be missing in {self.path}")
            time.sleep(0.05)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows dropped so far, by query."""
    return store.rows(spark, path, schemas.struct(LATE)).groupBy("query").agg(F.sum("dropped").alias("dropped"))
