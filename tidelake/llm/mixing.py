"""Mixing sources to target weights by Pareto order sampling, in built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import settle, small_side, table, word_count

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
MAX_COPIES = 2.0
#: Pieces into which the ranks of a source are cut before only one piece is sorted.
PIECES = 4096
SEED = 7_919
#: Columns that tell sources apart, a null source from an empty one.
SOURCE = ["_null", "_source"]


def capped_shares(df: DataFrame, group: Sequence[str], weight: str, cap: str, budget: str, tie: Sequence[str], share: str) -> DataFrame:
    """Split ``budget`` by weight; no share exceeds its cap, and the excess goes to the others by weight.

    In closed form: in ascending order of cap over weight, a prefix is capped, and the first row whose share at the
    common rate stays below its cap fixes that rate for itself and all behind it.
    """
    rows = df.withColumn("_ratio", F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0)))
    order = Window.partitionBy(*group).orderBy("_ratio", *tie)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.greatest(F.col(budget) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)), F.lit(0.0))
    rows = rows.withColumn("_rate", F.try_divide(left, F.sum(weight).over(after)))
    rows = rows.withColumn("_full", F.coalesce(F.col("_rate") * F.col(weight) >= F.col(cap), F.lit(True)))
    free = F.when(~F.col("_full"), F.struct("_ratio", *tie, "_rate"))
    common = F.min(free).over(Window.partitionBy(*group))["_rate"]
    rows = rows.withColumn("_common", common)
    rows = rows.withColumn(share, F.when(F.col("_full"), F.col(cap)).otherwise(F.col("_common") * F.col(weight)))
    return rows.drop("_ratio", "_rate", "_full", "_common")


def sized(docs: DataFrame) -> DataFrame:
    """Of each row: source, size in words, length class and rank hash. Nothing else is needed to plan a mix."""
    size = word_count(F.col("text"))
    return docs.select(
        F.col("source").isNull().alias("_null"),
        F.coalesce("source", F.lit("")).alias("_source"),
        F.col("doc_id").cast("long").alias("_id"),
        size.alias("_size"),
        _uniform(F.col("doc_id"), F.col("text")).alias("_u"),
    ).withColumn("_level", _level(F.col("_size")))


def _uniform(doc_id: Column, text: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(doc_id.cast("long"), text, F.lit(SEED)), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(2**53))


def _level(size: Column) -> Column:
    """Binary length class of a size: 0 for 0, 1 for 1, 2 for 2 and 3, 3 for 4 to 7 and so on."""
    return F.when(size > 0, F.floor(F.log2(size.cast("double"))) + 1).otherwise(0).cast("int")


def _rank(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds, mapped from [0, inf) to [0, 1) in the same order."""
    lost, won = u * (1 - inclusion), (1 - u) * inclusion
    return lost / (lost + won)


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MAX_COPIES) -> DataFrame:
    """Words wanted of each source. Sources in code-point order, null last, take the weights in turn."""
    sources = rows.groupBy(*SOURCE).agg(F.sum("_size").alias("_words"))
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(Window.orderBy(*SOURCE)) - 1, F.lit(len(weights))).cast("int")
    weighed = sources.select(
        *SOURCE, F.col("_words").cast("long").alias("_words"), F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("_weight"),
        (F.lit(float(most)) * F.col("_words")).alias("_cap"), (F.lit(float(budget)) * F.sum("_words").over(everything)).alias("_budget"),
    )
    return capped_shares(weighed, [], "_weight", "_cap", "_budget", SOURCE, "_target").select(*SOURCE, "_words", "_target")


def mix_plan(rows: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MAX_COPIES) -> DataFrame:
    """One row per source and length class: certain copies, inclusion of one more copy, and the source's rank limit.

    The expected copies of a document are its source's rate times 1 + its length class (longer texts are drawn
    sooner), at most ``most``; the rate meets the target exactly in expectation. Their whole part is certain. The
    rest is an inclusion probability: documents are ranked by random odds over inclusion odds, and the first ones are taken
    until the missing words are there, the last one if that is nearer to the target than leaving it. The limit is found
    by summing the pieces of the rank and sorting one piece.
    """
    targets = source_targets(rows, weights, budget, most)
    levels = rows.groupBy(*SOURCE, "_level").agg(F.sum("_size").cast("double").alias("_level_words"))
    levels = levels.join(targets, SOURCE).select(
        "*", ((1 + F.col("_level")) * F.col("_level_words")).alias("_weight"), (F.lit(float(most)) * F.col("_level_words")).alias("_cap")
    )
    shares = capped_shares(levels, SOURCE, "_weight", "_cap", "_target", ["_level"], "_share")
    copies = F.coalesce(F.try_divide(F.col("_share"), F.col("_level_words")), F.lit(0.0))
    planned = shares.select(*SOURCE, "_level", "_words", "_target", "_level_words", F.least(copies, F.lit(float(most))).alias("_copies"))
    planned = planned.withColumn("_certain", F.floor("_copies").cast("int"))
    planned = settle(planned.withColumn("_inclusion", F.col("_copies") - F.col("_certain")))
    missing = planned.groupBy(*SOURCE).agg(F.sum(F.col("_inclusion") * F.col("_level_words")).alias("_missing"))

    drawn = rows.join(small_side(planned).select(*SOURCE, "_level", "_inclusion"), [*SOURCE, "_level"])
    drawn = drawn.filter((F.col("_inclusion") > 0) & (F.col("_size") > 0))
    drawn = drawn.withColumn("_rank", _rank(F.col("_u"), F.col("_inclusion")))
    drawn = drawn.withColumn("_piece", F.floor(F.col("_rank") * PIECES).cast("int"))
    pieces = drawn.groupBy(*SOURCE, "_piece").agg(F.sum("_size").alias("_in"))
    upto = Window.partitionBy(*SOURCE).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_in").over(upto), F.lit(0))).join(missing, SOURCE)
    last = pieces.filter((F.col("_before") < F.col("_missing")) & (F.col("_missing") <= F.col("_before") + F.col("_in")))
    last = last.select(*SOURCE, "_piece", (F.col("_missing") - F.col("_before")).alias("_open"))

    within = drawn.join(small_side(settle(last)), [*SOURCE, "_piece"])
    so_far = F.sum("_size").over(Window.partitionBy(*SOURCE, "_piece").orderBy("_rank", "_id").rowsBetween(Window.unboundedPreceding, 0))
    within = within.withColumn("_sum", so_far).filter(F.col("_sum") - F.col("_size") / 2 <= F.col("_open"))
    limits = within.groupBy(*SOURCE).agg(F.max("_rank").alias("_limit"))
    floors = last.select(*SOURCE, (F.col("_piece") / F.lit(float(PIECES))).alias("_floor"))
    # A source without a crossing piece misses nothing (no limit needed) or, by rounding, everything.
    result = planned.join(floors, SOURCE, "left").join(limits, SOURCE, "left")
    limit = F.coalesce("_limit", F.col("_floor") * F.lit(1 - 1e-15), F.lit(1.0))
    return settle(result.select(*SOURCE, "_level", "_words", "_target", "_certain", "_inclusion", limit.alias("_limit")))


def _copies(certain: str = "_certain") -> Column:
    taken = (F.col("_inclusion") > 0) & (_rank(F.col("_u"), F.col("_inclusion")) <= F.col("_limit"))
    return F.col(certain) + F.when(taken, 1).otherwise(0)


def mixed_sizes(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row.

    Null text: size 0, taken 0. A null source is a source, after all others. Equal rows have one rank and are taken
    together. An empty table gives no rows; sources without words have target 0. Other columns are not read.
    """
    rows = settle(sized(docs))
    plan = small_side(mix_plan(rows, weights, budget, most))
    joined = rows.join(plan, [*SOURCE, "_level"])
    return joined.select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_words").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * _copies()).cast("long").alias("taken"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, most: float = MAX_COPIES) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan takes it, in the columns of ``docs``.

    A document without words cannot help a target; it keeps one copy. Everything else is as in ``mixed_sizes``.
    """
    plan = small_side(mix_plan(settle(sized(docs)), weights, budget, most))
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col("doc_id"), F.col("text"), F.col("source"))
    keyed = held.select(
        "_row", F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_source"),
        word_count(F.col("text")).alias("_size"), _uniform(F.col("doc_id"), F.col("text")).alias("_u"),
    ).withColumn("_level", _level(F.col("_size")))
    counted = keyed.join(plan, [*SOURCE, "_level"])
    times = F.when(F.col("_size") > 0, _copies()).otherwise(1)
    repeated = counted.select("_row", F.explode(F.sequence(F.lit(0), times)).alias("_copy"))
    return repeated.filter("_copy > 0").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mixed_sizes(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
