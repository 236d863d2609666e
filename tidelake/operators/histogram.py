"""Exact group percentiles from counted values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How often each value occurs per key combination (``n``).

    The counts are combined inside every task, so what is shuffled is bounded by
    keys x distinct values however dominant one key is.
    """
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def with_percentile(counts: DataFrame, key: str, value: str, q: float, name: str) -> DataFrame:
    """Add the smallest value that at least a share ``q`` of the key's rows do not exceed.

    Same definition as the discrete percentile, and exact for any group size,
    where a sketch drifts beyond ten thousand rows. ``value`` must have a bounded
    range, as passenger counts do after cleaning (1 to 400): a key's counts meet
    in one task, and there are at most range x blocks of them.
    """
    n, known = F.col("n"), F.col(value).isNotNull()
    counted = F.when(known, n).otherwise(0)
    upto = Window.partitionBy(key).orderBy(F.asc_nulls_last(value)).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy(key)
    # Shares are compared as whole thousandths of rows, free of binary fractions.
    reached = F.sum(counted).over(upto) * 1000 >= F.sum(counted).over(whole) * round(q * 1000)
    return (
        counts.withColumn("_reached", reached & known)
        .withColumn(name, F.min(F.when(F.col("_reached"), F.col(value))).over(whole))
        .drop("_reached")
    )
