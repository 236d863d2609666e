"""A Merkle manifest of a table: a content-addressed store of digest-to-children records, and proofs read by descending it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import settle, table
from tidelake.operators.ordering import number_rows
from tidelake.session import scratch

#: A node has up to 2 ** DIGIT children; a rank's digits of so many bits name the way from the root to its leaf.
DIGIT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a rank.
_BITS = 62


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its text, or as ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _depth(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves: the least d with 8 ** d >= size."""
    steps = [F.when(size > F.lit(1 << (DIGIT * d)), 1).otherwise(0) for d in range(_BITS // DIGIT)]
    return sum(steps[1:], steps[0])


def _up(rank: Column, levels: int = 1) -> Column:
    return F.shiftright(rank, DIGIT * levels)


def build(leaves: DataFrame, path: str) -> tuple[DataFrame | None, DataFrame]:
    """Trees over the ``leaves`` (_group, _rank, _depth, _digest), one for each group, level by level.

    Children of one parent meet in one group of at most 8 rows. Each level's records (digest, children) are written below ``path``,
    one record for each digest, so equal subtrees are stored once. Returns the store (None if no tree has a parent) and
    the roots (_group, _depth, _digest).
    """
    spark = leaves.sparkSession
    most = leaves.agg(F.max("_depth")).first()[0] or 0
    level, roots = leaves, []
    for height in range(1, most + 1):
        roots.append(level.filter(F.col("_depth") < height))
        grouped = level.filter(F.col("_depth") >= height).groupBy("_group", "_depth", _up(F.col("_rank")).alias("_rank"))
        ordered = F.array_sort(F.collect_list(F.struct("_rank", "_digest")))
        parents = grouped.agg(F.transform(ordered, lambda c: c["_digest"]).alias("children"))
        nodes = settle(parents.withColumn("_digest", F.sha2(F.array_join("children", ""), 256)))
        records = nodes.groupBy(F.col("_digest").alias("digest")).agg(F.first("children").alias("children"))
        records.write.parquet(f"{path}/height={height}")
        level = nodes.drop("children")
    roots.append(level)
    tops = roots[0]
    for other in roots[1:]:
        tops = tops.unionByName(other)
    store = spark.read.parquet(path) if most else None
    return store, tops.select("_group", "_depth", "_digest")


def descend(store: DataFrame | None, tops: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (_group, _rank, _depth and others) with the _path that leads to each, and the digest _found at its end.

    Requests start at the record of their group's root (``tops``: _group, _depth, _digest, _top, _path) and follow the digits of
    their rank, the highest first. A step looks the digest up in the store, adds the children left and right of the selected one as
    a segment to the path, and goes on with the selected one. Requests that share their first digits take those steps
    as one row: at a level there are as many rows as nodes asked for. A path is in order from the root.
    """
    most = requests.agg(F.max("_depth")).first()[0] or 0
    top = tops.select("_group", "_depth", F.lit(0).cast("long").alias("_node"), "_top", F.col("_digest").alias("_found"), "_path")
    asked = [requests.withColumnRenamed("_rank", "_node")]
    for height in range(1, most):
        below = asked[-1].filter(F.col("_depth") > height)
        asked.append(settle(below.select("_group", "_depth", _up(F.col("_node")).alias("_node")).distinct()))
    landed = None  # nodes of the height below, for the trees that are at least so high
    for height in range(most, 0, -1):
        here = top.filter(F.col("_depth") == height)
        here = here.unionByName(landed) if landed is not None else here
        records = store.filter(F.col("height") == height).select(F.col("digest").alias("_found"), "children")
        opened = here.join(records, "_found").select("_group", F.col("_node").alias("_above"), "_top", "_path", "children")
        wanted = asked[height - 1].filter(F.col("_depth") >= height).withColumn("_above", _up(F.col("_node")))
        met = wanted.join(opened, ["_group", "_above"])
        pick = F.col("_node").bitwiseAND((1 << DIGIT) - 1).cast("int")
        segment = F.struct(
            F.array_join(F.slice("children", F.lit(1), pick), "").alias("left"),
            F.array_join(F.slice("children", pick + 2, F.size("children")), "").alias("right"),
        )
        landed = met.withColumn("_found", F.get("children", pick)).withColumn("_path", F.concat("_path", F.array(segment)))
        landed = landed.drop("children", "_above")
    lone = asked[0].filter(F.col("_depth") == 0).join(top.select("_group", "_top", "_found", "_path"), "_group")
    found = lone if landed is None else landed.unionByName(lone)
    return found.withColumnRenamed("_node", "_rank")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, those of the leaf first and those next to the root last."""
    return F.sha2(F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(F.reverse(path), leaf, lambda below, s: digest(s["left"], below, s["right"]))


def manifest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    Leaves of a lang ascend by doc_id (null first; rows of one id by their digest, so repeated rows are leaves of their own). A null
    lang is a lang, before all others and apart from an empty one. Rows whose doc_id has a checksum divisible by 3 are folded from
    a leaf whose text has its A-Z lower-cased: without such letters, or without text or id, they stay as they are. No rows give no
    rows. Only the five columns are read; texts are read once, in the task that reads their file. The records are
    written below ``path``.
    """
    fields = {c: F.col(c) for c in FIELDS}
    tampered = {**fields, "text": F.translate("text", UPPER, LOWER)}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    rows = docs.select(
        F.concat(F.lit("="), F.col("lang")).alias("_group"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(list(fields.values())).alias("_digest"),
        F.when(hit & F.col("text").rlike("[A-Z]"), leaf_digest(list(tampered.values()))).alias("_altered"),
    ).fillna({"_group": ""})
    numbered = number_rows(settle(rows), ["_group"], ["doc_id", "_digest"], "_rank", "_size")
    leaves = settle(numbered.withColumn("_depth", _depth(F.col("_size"))).drop("_size"))
    store, subroots = build(leaves.select("_group", "_rank", "_depth", "_digest"), f"{path}/langs")

    langs = number_rows(subroots.select(F.col("_group").alias("_lang"), "_digest"), [], ["_lang"], "_rank", "_size")
    langs = settle(langs.select("_lang", "_digest", F.lit("").alias("_group"), "_rank", _depth(F.col("_size")).alias("_depth")))
    over, tops = build(langs.drop("_lang"), f"{path}/root")
    root = tops.select(F.max("_digest")).first()[0]  # of the one group; none if there are no rows

    no_path = F.array().cast("array<struct<left:string,right:string>>")
    start = tops.select("*", F.col("_digest").alias("_top"), no_path.alias("_path"))
    entered = settle(descend(over, start, langs.drop("_digest")).select("_lang", "_found", "_path"))
    entries = subroots.join(entered.withColumnRenamed("_lang", "_group"), "_group")
    entries = entries.select("_group", "_depth", "_digest", F.col("_found").alias("_top"), "_path")
    proven = descend(store, entries, leaves.withColumnRenamed("_digest", "_leaf"))
    folded = fold(F.coalesce("_altered", "_found"), F.col("_path"))
    out = proven.select(
        "doc_id", F.col("_found").alias("leaf"), F.col("_top").alias("subroot"), F.lit(root).cast("string").alias("root"),
        proof_digest(F.col("_path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents", *FIELDS), scratch(spark, "merkle"))
