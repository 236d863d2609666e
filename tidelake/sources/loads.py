"""A growing table as its loads left it: versions, instants and differences, from the batch and load time of every row.

A load is a batch of ``tables.put_batch`` whose rows carry the time they were loaded. Loads are numbered by that time, then
by key. A batch that was loaded again has moved to its last load, as its earlier rows are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.trips import audit_ts
from tidelake.operators.sizing import broadcast_if_small
from tidelake.sources.tables import BATCH


def history(table: DataFrame, loaded_at: str) -> DataFrame:
    """One row per load: number, time, what it added, and the total after it.

    Rows are counted per load inside every task; only loads are numbered, of which there are as many as files came in.
    """
    loads = table.groupBy(BATCH).agg(F.max(loaded_at).alias("committed_at"), F.count(F.lit(1)).alias("added_records"))
    order = Window.orderBy("committed_at", BATCH)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return loads.select(
        F.row_number().over(order).alias("snapshot_id"), "committed_at", F.lit("append").alias("operation"), "added_records",
        F.sum("added_records").over(upto).alias("total_records"), F.col(BATCH).alias("batch_key"),
    )


def _of_loads(table: DataFrame, loads: DataFrame) -> DataFrame:
    keys = broadcast_if_small(loads.select(F.col("batch_key").alias("_key")))
    return table.join(keys, F.col(BATCH) == F.col("_key"), "left_semi")


def as_of_load(table: DataFrame, number: int, loaded_at: str) -> DataFrame:
    """The rows after the load of that number."""
    return _of_loads(table, history(table, loaded_at).filter(F.col("snapshot_id") <= number))


def as_of_time(table: DataFrame, instant: Column | str, loaded_at: str) -> DataFrame:
    """The rows of all loads that were done by an instant. A row carries the time of its load, so nothing is looked up."""
    return table.filter(F.col(loaded_at) <= audit_ts(instant))


def delta(table: DataFrame, before: int, after: int, loaded_at: str) -> DataFrame:
    """How many rows there were after two loads, and the difference."""
    number = F.col("snapshot_id")
    counts = history(table, loaded_at).agg(*[
        F.coalesce(F.sum(F.when(number <= n, F.col("added_records"))), F.lit(0)).alias(name)
        for n, name in ((before, "rows_before"), (after, "rows_after"))
    ])
    return counts.withColumn("delta", F.col("rows_after") - F.col("rows_before"))


def counts_by(table: DataFrame, day: Column) -> DataFrame:
    """Rows per day."""
    return table.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
