"""Row rules applied in order, with a count of what each one discards."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

NULL_MEASURE = "null_measure"


@dataclass(frozen=True)
class Rule:
    """``reject`` true discards the row, and so does NULL (a value that cannot be judged).

    A row is counted under the rules of the first stage that discards it; rules
    sharing a stage are counted independently of each other. ``upstream`` marks
    reasons that should never occur and point at a fault before this job.
    """

    name: str
    reject: Column
    stage: int
    upstream: bool = False


def _passes(rules: Iterable[Rule]) -> Column:
    return reduce(and_, [F.coalesce(~r.reject, F.lit(False)) for r in rules], F.lit(True))


def keep_clean(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that pass every rule: plain filters, so that they reach the scan."""
    for rule in rules:
        df = df.filter(~rule.reject)
    return df


def _stages(rules: list[Rule]) -> list[tuple[int, list[Rule]]]:
    return [(s, [r for r in rules if r.stage == s]) for s in sorted({r.stage for r in rules})]


def failed_stage(rules: list[Rule]) -> Column:
    """Number of the first stage a row fails, NULL for a clean row."""
    return F.coalesce(*[F.when(~_passes(members), F.lit(stage)) for stage, members in _stages(rules)])


def reject_reason(rules: list[Rule]) -> Column:
    """Name of the first rule that discards a row, NULL for a clean row."""
    steps = []
    for rule in rules:
        steps.append(F.when(rule.reject, rule.name))
        steps.append(F.when(rule.reject.isNull(), NULL_MEASURE))
    return F.coalesce(*steps)


def discard_counts(rules: list[Rule], stage_col: str = "_failed_stage") -> list[Column]:
    """Aggregates counting each reason, given the failed stage of every row."""
    counts = []
    for rule in rules:
        here = F.col(stage_col) == rule.stage
        counts.append(F.count_if(here & F.coalesce(rule.reject, F.lit(False))).alias(rule.name))
    unknown = reduce(
        lambda a, b: a | b, [(F.col(stage_col) == r.stage) & r.reject.isNull() for r in rules], F.lit(False)
    )
    counts.append(F.count_if(unknown).alias(NULL_MEASURE))
    return counts


def accounting(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``reason, discarded, upstream_alert`` for all rules, from one pass over the rows.

    Besides the reasons there are ``_read``, ``_kept`` and ``_discarded`` totals. The
    aggregate is global and fully combined before its single-row shuffle.
    """
    totals = df.withColumn("_failed_stage", failed_stage(rules)).agg(
        *discard_counts(rules),
        F.count(F.lit(1)).alias("_read"),
        F.count_if(F.col("_failed_stage").isNull()).alias("_kept"),
        F.count_if(F.col("_failed_stage").isNotNull()).alias("_discarded"),
    )
    upstream = [r.name for r in rules if r.upstream]
    return totals.unpivot([], totals.columns, "reason", "discarded").withColumn(
        "upstream_alert", F.col("reason").isin(upstream) & (F.col("discarded") > 0)
    )


def observe_discards(df: DataFrame, rules: list[Rule], observation: Observation) -> DataFrame:
    """Filter like ``keep_clean`` while counting the reasons on the way to a write.

    A monitoring figure: tasks that run again after a lost executor may count
    twice. ``accounting`` gives the exact numbers.
    """
    marked = df.withColumn("_failed_stage", failed_stage(rules)).observe(
        observation, *discard_counts(rules), F.count(F.lit(1)).alias("_read")
    )
    return marked.filter(F.col("_failed_stage").isNull()).drop("_failed_stage")
