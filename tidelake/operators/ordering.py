"""Numbers of rows in a total order, without bringing a group or the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators.sizing import broadcast_if_small
from tidelake.session import settle

#: Bits of ``monotonically_increasing_id`` that hold the place inside a partition.
_PLACE_BITS = 33


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], number: str, total: str | None = None, parts: int | None = None
) -> DataFrame:
    """``df`` with the place (from 0, no gap) of each row in its group by the ascending order columns, nulls first.

    Rows are range-partitioned by group and order, sorted inside the partitions and numbered there; what a group has in the
    partitions before, at most one count per group and partition boundary, gives each partition its first number. A group that
    holds most of the table spreads over many partitions. Rows equal in all named columns follow each other in any order, and
    may spread too. ``total`` names a further column with the rows of the group. No rows give no rows.
    """
    tie, at, part = (_free(df, name) for name in ("_tie", "_at", "_part"))
    keys = [f"`{c}`" for c in (*group, *order)]
    parts = parts or max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(parts, *keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    held = settle(dealt.withColumn(at, F.monotonically_increasing_id())).withColumn(part, F.shiftright(at, _PLACE_BITS))
    own = [f"`{c}`" for c in group]
    pieces = held.groupBy(*own, part).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_from"))
    before = Window.partitionBy(*own).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_from")
    of_group = F.sum("_n").over(Window.partitionBy(*own))
    offsets = pieces.select(
        *[F.col(c).alias(f"_g{k}") for k, c in enumerate(own)], F.col(part).alias("_p"), first.alias("_first"), of_group.alias("_total")
    )
    same = held[part] == F.col("_p")
    for k, c in enumerate(own):
        same = same & held[c].eqNullSafe(F.col(f"_g{k}"))
    joined = held.join(broadcast_if_small(offsets), same)
    added = [(F.col("_first") + F.col(at)).alias(number), *([F.col("_total").alias(total)] if total else [])]
    return joined.select(*[held[f"`{c}`"] for c in df.columns], *added)


def rank_all(df: DataFrame, group: Sequence[str], by: Sequence[str], rank: str) -> DataFrame:
    """``df`` with the competition rank (ties share a rank, the next one skips) of every row in its group, nulls first.

    The rank is the number of the first of the equal rows: a minimum per value over ``number_rows``, so ties need no window.
    """
    place = _free(df, "_place")
    numbered = number_rows(df, group, by, place)
    keys = [f"`{c}`" for c in (*group, *by)]
    firsts = numbered.groupBy(*keys).agg((F.min(place) + 1).alias("_rank"))
    firsts = firsts.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(keys)], "_rank")
    same = F.lit(True)
    for k, c in enumerate(keys):
        same = same & numbered[c].eqNullSafe(F.col(f"_k{k}"))
    return numbered.join(firsts, same).select(*[numbered[f"`{c}`"] for c in df.columns], F.col("_rank").alias(rank))
