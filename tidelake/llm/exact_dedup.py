"""Exact deduplication: local, then per salted digest group, then globally, on digest and full content each time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import SPACE, table

#: Salts over which the copies of one text are spread before the global merge.
SALTS = 16


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def _order(doc_id: Column) -> Column:
    """Smallest id first, null ids last."""
    return F.struct(doc_id.isNull().alias("absent"), doc_id.alias("doc_id"))


def merge_copies(keyed: DataFrame, best: dict[str, Column], again: dict[str, Column], salts: int = SALTS) -> DataFrame:
    """One row per (digest, content) of ``keyed``.

    Grouping is by digest and full content, so equal digests of different contents never merge. The first aggregate
    combines the copies of a task before its shuffle and then those of one salt (the task's number), the second one
    combines the winners of the salts: a text that fills a third of the table reaches the last task as ``salts`` rows.
    """
    salted = keyed.groupBy("_digest", "_content", F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"))
    local = salted.agg(*[c.alias(k) for k, c in best.items()])
    return local.groupBy("_digest", "_content").agg(*[c.alias(k) for k, c in again.items()])


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Null texts equal empty ones. A null id loses against any other. Of rows that share both id and text exactly one is
    kept. Other columns are not read; an empty table gives no rows.
    """
    content = normalised(F.col("text"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content.alias("_content"))
    keyed = keyed.withColumn("_digest", F.sha2("_content", 256))
    order = _order(F.col("doc_id"))
    winners = merge_copies(
        keyed, {"_best": F.min(order), "_n": F.count(F.lit(1))}, {"_best": F.min("_best"), "_n": F.sum("_n")}
    )
    # Lengths and a second hash join the digest as key, so that two contents of one digest would stay apart here too.
    second = [F.xxhash64("_content").alias("_second"), F.length("_content").alias("_length")]
    winners = winners.select("_digest", *second, F.col("_best.doc_id").alias("keep_id"), F.col("_n").alias("group_size"))
    rows = keyed.select("doc_id", "_digest", *second).join(winners, ["_digest", "_second", "_length"])
    twin = Window.partitionBy("doc_id", "_digest", "_second").orderBy("_length")
    first = F.row_number().over(twin) == 1
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The row of the smallest id of each distinct text, in the columns of ``docs``.

    Of rows with equal ids and normalised texts the one with the smaller raw text hash stays.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(
        row.alias("_row"), normalised(F.col("text")).alias("_content"),
        F.struct(_order(F.col("doc_id")), F.xxhash64("text")).alias("_order"),
    ).withColumn("_digest", F.sha2("_content", 256))
    winners = merge_copies(
        keyed, {"_best": F.min_by("_row", "_order"), "_first": F.min("_order")}, {"_best": F.min_by("_best", "_first")}
    )
    return winners.select("_best.*")


def query(spark, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
