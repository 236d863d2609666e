"""Rendezvous hashing of record keys over weighted shards, with gapless places inside each shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import table

SHARDS = 16
#: Pieces in which the rows of one shard are numbered; a piece is one window group.
PIECES = 512
SEED = 20_231


def rendezvous(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """The shard with the highest score ``-weight / ln(u)``, ``u`` a hash of key and shard in (0, 1).

    A shard gets keys in proportion to its weight. Scores do not depend on other shards, so a further shard only
    takes keys into itself, and a removed one only gives its own away. A null key is a key like any other.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    scores = []
    for shard, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 11)
        u = (bits.cast("double") + 0.5) / F.lit(float(2**53))
        scores.append(F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(shard).alias("shard")))
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def with_slots(df: DataFrame, group: str, order: Sequence[str], slot: str, pieces: int = PIECES) -> DataFrame:
    """Number the rows of each group from 0 without a gap, without bringing a group into one task.

    Rows fall into ``pieces`` by a hash of the order columns. The pieces' counts (pre-aggregated, at most groups
    times pieces rows) give each piece its first number; a window numbers the rows of a piece. Rows equal in all
    order columns take neighbouring numbers in any order.
    """
    piece = "_piece"
    while piece in df.columns:
        piece += "_"
    dealt = df.withColumn(piece, F.pmod(F.xxhash64(*order, F.lit(SEED)), F.lit(pieces)).cast("int"))
    counts = dealt.groupBy(group, piece).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, piece, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy(group, piece).orderBy(*order)
    numbered = dealt.withColumn("_row", F.row_number().over(within))
    joined = numbered.join(first, [group, piece])
    return joined.withColumn(slot, F.col("_first") + F.col("_row") - 1).drop(piece, "_first", "_row")


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    The law is ``key``: doc_id and the weights decide alone, so equal texts under different ids may part. ``grown``
    (one more shard of the last weight unless given) yields grown_shard. Null text: size 1 and checksum 0.
    Null or repeated ids go where their key goes; rows equal in all columns get slots of their own. An empty
    table gives no rows. Other columns of ``docs`` are not read.
    """
    grown = list(grown) if grown else [*weights, *weights[-1:]]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    ).select("*", rendezvous(F.col("doc_id"), weights).cast("int").alias("shard"),
             rendezvous(F.col("doc_id"), grown).cast("int").alias("grown_shard"))
    slotted = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def query(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), [1.0] * SHARDS)
