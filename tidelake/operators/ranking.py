"""Top-k, ranks and standard scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, metric: str, *ties: str) -> DataFrame:
    """Highest ``n`` by metric. ``ties`` break equal metrics, so the result is always the same.

    Each task keeps its own best ``n`` and only those meet; nothing is sorted whole.
    """
    return df.orderBy(F.desc(metric), *ties).limit(n)


def with_rank(df: DataFrame, n: int, metric: str, *ties: str) -> DataFrame:
    """Top ``n`` numbered from 1; the numbering window sees those ``n`` rows only."""
    best = Window.orderBy(F.desc(metric), *ties)
    return top_n(df, n, metric, *ties).withColumn("rank", F.row_number().over(best))


def zscore(value: Column, mean: Column, sigma: Column, eps: float = 1e-6) -> Column:
    """Distance from the mean in standard deviations; 0 where the spread vanishes."""
    return F.when(sigma > eps, (value - mean) / sigma).otherwise(0.0)


def moments(value: Column) -> tuple[Column, Column]:
    """Mean and population standard deviation, 0 for no rows."""
    return F.coalesce(F.avg(value), F.lit(0.0)), F.coalesce(F.stddev_pop(value), F.lit(0.0))


def exact_avg(value: Column, digits: int) -> Column:
    """Average of values that are themselves rounded, summed as decimals.

    Summing doubles in task order would make the last digit depend on the cluster.
    """
    return F.round(F.avg(value.cast("decimal(20,10)")), digits).cast("double")
