"""Connected components of an edge table by randomised contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import MAX_BROADCAST_ROWS, stored

#: Narrow rows a partition may have, and the partitions that even a short table has: links are few beside the texts, so a
#: table of them does without the partitions that the texts need.
ROWS, LEAST = 50_000, 8


def _fewer(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many rows, in no more partitions than they need."""
    return df.coalesce(max(LEAST, -(-rows // ROWS)))


def _side(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _pair(node: str, other: str) -> Column:
    return F.struct(F.col(node).alias("node"), F.col(other).alias("other"))


def _order(node: Column, turn: int) -> Column:
    """Nodes by number in the first round, which settles stars around their least node, then by a hash without collisions."""
    return F.xxhash64(F.lit(turn), node) if turn else node


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long); root is the least node of its component.

    Each round maps every node to the first of its neighbourhood, itself included, in an order drawn anew, from there to that
    node's first, and keeps the distinct edges between different images: a quarter of the nodes with edges or more goes in a
    round on average, whatever the graph. It ends when no edge is left, without a round that only confirms. First ones are
    pre-aggregated and joined back, so a node with a third of all edges is no group of its own.
    """
    current = stored(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b"))
    rows = current.count()
    current = _fewer(current, rows)
    steps: list[tuple[DataFrame, int]] = []
    while rows:
        turn = len(steps)
        both = current.select(F.explode(F.array(_pair("a", "b"), _pair("b", "a"))).alias("pair")).select("pair.*")
        first = both.groupBy("node").agg(F.min_by("other", _order(F.col("other"), turn)).alias("first"))
        own = _order(F.col("node"), turn) < _order(F.col("first"), turn)
        hop = stored(_fewer(first.select("node", F.when(own, F.col("node")).otherwise(F.col("first")).alias("to")), 2 * rows))
        again = _side(hop.select(F.col("node").alias("to"), F.col("to").alias("then")), 2 * rows)
        step = stored(_fewer(hop.join(again, "to").select("node", F.col("then").alias("to")), 2 * rows))
        steps.append((step, 2 * rows))
        of_a, of_b = (_side(step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")), 2 * rows) for c in "ab")
        images = current.join(of_a, "a").join(of_b, "b").filter("a_to <> b_to")
        current = stored(_fewer(images.select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b")).distinct(), rows))
        rows = current.count()
    if not steps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    placed, nodes = steps[0]
    for step, most in steps[1:]:
        then = _side(step.select(F.col("node").alias("to"), F.col("to").alias("then")), most)
        placed = placed.join(then, "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    placed = stored(_fewer(placed, nodes))
    roots = _fewer(placed.groupBy("to").agg(F.min("node").alias("root")), nodes)
    return placed.join(_side(roots, nodes), "to").select("node", "root")
