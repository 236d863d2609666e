"""Stream sinks: closed windows by batch, current state on read, retention, and the confirmation log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.functions.events import iso_format
from tidelake.operators.retention import retain, unexpired
from tidelake.streaming import store

BatchWriter = Callable[[DataFrame, int], None]


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """A name for a micro-batch that no other one has.

    Batch numbers restart with a new checkpoint, so the id that Spark keeps in the checkpoint comes first: a replay has
    the same name, and the first batch of a new checkpoint has another one than that of the old.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("not called by a streaming query")
    return f"{query}-{batch_id}"


def window_writer(path: str, key: Callable[[DataFrame, int], str] = batch_key) -> BatchWriter:
    """``foreachBatch`` writer that adds the windows a batch closed; a replayed batch writes over its own rows."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.put(batch, path, key(batch, batch_id))

    return sink


def fan_out_writer(split: Callable[[DataFrame, str], DataFrame], writers: dict[str, BatchWriter]) -> BatchWriter:
    """Writer of several tables from one stream: ``split`` takes the rows of each out of the batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the stateful plan must not run once for every table
        try:
            for name, writer in writers.items():
                writer(split(batch, name), batch_id)
        finally:
            batch.unpersist()

    return sink


def every(writer: BatchWriter, batches: int, then: Callable) -> BatchWriter:
    """After every so many micro-batches call ``then`` with the session: no other batch is written meanwhile."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        if batches and (batch_id + 1) % batches == 0:
            then(batch.sparkSession)

    return sink


def history(spark, path: str, schema) -> DataFrame:
    """Every window written so far."""
    return store.rows(spark, path, schema)


def latest(rows: DataFrame, key: str, order: str = "window_end") -> DataFrame:
    """Newest row per key, at equal times the one updated last; combined inside every task before the shuffle."""
    tie = ["last_updated"] if "last_updated" in rows.columns else []
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(order, *tie)).alias("_row"))
    return newest.select("_row.*")


def alive(rows: DataFrame, name: str, as_of: Column | str, limits: dict[str, tuple[str, int]] = schemas.RETENTION) -> DataFrame:
    """Rows of an operational table that have not expired."""
    column, seconds = limits[name]
    return retain(rows, column, seconds, as_of)


def purge(
    spark, path: str, schema, name: str, key: str, as_of: Column | str, limits: dict[str, tuple[str, int]] = schemas.RETENTION
) -> None:
    """Merge the micro-batches of an operational table, clustered by ``key``, and leave its expired rows behind.

    Readers filter by the same rule at any time; this keeps the folder from growing. It may run beside the stream.
    """
    column, seconds = limits[name]
    store.merge(spark, path, schema, key, unexpired(column, seconds, as_of))


def _line(rows: DataFrame) -> Column:
    shown = [iso_format(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in rows.schema.fields]
    return F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("value")


def confirmation_log(rows: DataFrame) -> DataFrame:
    """Emitted windows as JSON lines with ISO times."""
    return rows.select(_line(rows))


#: The confirmation log: a line, and the end of its window, by which it expires after a day.
LOG = schemas.struct("value string, window_end timestamp")
LOG_RETENTION = {"log": ("window_end", 86_400)}


def with_log(writer: BatchWriter, path: str, key: Callable[[DataFrame, int], str] = batch_key) -> BatchWriter:
    """Also write each batch's confirmation lines; a replayed batch writes over its own."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        # Both writes use the rows: the stateful plan must not run twice.
        batch.persist()
        try:
            writer(batch, batch_id)
            store.put(batch.select(_line(batch), "window_end"), path, key(batch, batch_id))
        finally:
            batch.unpersist()

    return sink
