"""Running sums that restart at markers, spread over many tasks per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum_with_resets(
    df: DataFrame, key: str, order: list[str], amount: Column, reset: Column, slice_of: Column
) -> DataFrame:
    """Add ``run`` (restarts before the row) and ``running`` (sum since the last restart, row included).

    A restart clears the sum after its own row. ``slice_of`` must not decrease
    along ``order``, e.g. the hour of the event time. Each key's rows are summed
    slice by slice in parallel; a second, much smaller pass over one row per
    slice carries the open sum onwards. A key holding a large part of all rows
    is thus worked on by as many tasks as it has slices.
    """
    rows = df.withColumns(
        {
            "_amount": F.coalesce(amount, F.lit(0)),
            "_reset": F.coalesce(reset, F.lit(False)).cast("long"),
            "_slice": slice_of,
        }
    )
    part = Window.partitionBy(key, "_slice").orderBy(*order)
    earlier = part.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_local_run", F.coalesce(F.sum("_reset").over(earlier), F.lit(0)))
    stretch = Window.partitionBy(key, "_slice", "_local_run").orderBy(*order)
    rows = rows.withColumn(
        "_local_sum", F.sum("_amount").over(stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )

    stretches = rows.groupBy(key, "_slice", "_local_run").agg(
        F.sum("_amount").alias("_sum"), F.sum("_reset").alias("_resets")
    )
    # Per slice: its restarts, and the sum still open at its end (0 if it ends in a restart).
    slices = stretches.groupBy(key, "_slice").agg(
        F.sum("_resets").alias("_resets"),
        F.max("_local_run").alias("_last_run"),
        F.max_by("_sum", "_local_run").alias("_last_sum"),
    )
    slices = slices.withColumn("_tail", F.when(F.col("_last_run") == F.col("_resets"), F.col("_last_sum")).otherwise(0))

    by_slice = Window.partitionBy(key).orderBy("_slice")
    up_to_here = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A slice with a restart opens a new group; within a group the tails add up.
    slices = slices.withColumns(
        {
            "_group": F.count_if(F.col("_resets") > 0).over(up_to_here),
            "_runs_before": F.sum("_resets").over(up_to_here) - F.col("_resets"),
        }
    )
    in_group = Window.partitionBy(key, "_group").orderBy("_slice")
    slices = slices.withColumn(
        "_open", F.sum("_tail").over(in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    carried = slices.select(
        key, "_slice", "_runs_before", F.coalesce(F.lag("_open").over(by_slice), F.lit(0)).alias("_carry")
    )

    continues = F.col("_local_run") == 0
    return (
        rows.join(carried, [key, "_slice"])
        .withColumns(
            {
                "run": F.col("_runs_before") + F.col("_local_run"),
                "running": F.col("_local_sum") + F.when(continues, F.col("_carry")).otherwise(0),
            }
        )
        .drop("_amount", "_reset", "_slice", "_local_run", "_local_sum", "_runs_before", "_carry")
    )
