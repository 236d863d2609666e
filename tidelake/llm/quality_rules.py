"""Quality rules: fixed base rules, and a decision list learned from labelled statistics by sequential covering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidelake.llm.common import bytes_of, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: Labelled documents that a fit looks at; of more labels, those with the smallest hashes are taken.
MAX_LABELLED = 20_000
SEED = 4_241

#: What is counted in a text. The first five are the columns of the contract.
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_bytes", "n_upper", "n_digits", "n_marks", "n_distinct_words",
]
_COUNT_TYPE = StructType([StructField(c, LongType()) for c in COUNTS])


def count_text(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of one text, given in UTF-8."""
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    repeated = 0
    if n >= 3:
        pairs = np.unique(ids[:-2] * len(numbers) + ids[1:-1], return_inverse=True)[1]
        _, which, times = np.unique(pairs * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        often = times[which] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= often
        repeated = int(covered.sum())
    raw = np.frombuffer(text, np.uint8)
    kinds = np.bincount(raw, minlength=256)
    followers = int(kinds[0x80:0xC0].sum())  # bytes that continue a code point
    space = int(kinds[0x20] + kinds[0x09:0x0E].sum())
    return (
        n, len(raw) - followers - space, int(kinds[np.frombuffer(SYMBOLS, np.uint8)].sum()), len(lines) - len(set(lines)), repeated,
        len(lines), len(raw), int(kinds[0x41:0x5B].sum()), int(kinds[0x30:0x3A].sum()), int(kinds[[0x21, 0x2C, 0x2E, 0x3F]].sum()), len(numbers),
    )


@F.arrow_udf(_COUNT_TYPE)
def _count(texts: pa.Array) -> pa.Array:
    rows = [count_text(text) for text in bytes_of(texts)]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(COUNTS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)


# A deterministic function is called again in each filter on its result, by a second worker process beside each task's first.
_count = _count.asNondeterministic()


def statistics(text: Column) -> Column:
    """The counts of a text as a struct; a null text has none of anything."""
    return _count(text.cast("string"))


def base_failed(counts: Column) -> Column:
    repeats = 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    return (counts["n_words"] < MIN_WORDS) | repeats


#: Ratios that rules may test: name, count, divisor.
RATIOS = [
    ("symbol_share", "n_symbols", "word_chars"), ("upper_share", "n_upper", "word_chars"), ("digit_share", "n_digits", "word_chars"),
    ("mark_rate", "n_marks", "n_words"), ("word_length", "word_chars", "n_words"), ("line_words", "n_words", "n_lines"),
    ("repeat_share", "n_repeat_words", "n_words"), ("dup_line_share", "n_dup_lines", "n_lines"), ("distinct_share", "n_distinct_words", "n_words"),
]
FEATURES = [name for name, _, _ in RATIOS] + ["n_words"]


def features(counts: Column) -> list[Column]:
    ratios = [F.coalesce(F.try_divide(counts[top], counts[bottom].cast("double")), F.lit(0.0)).alias(name) for name, top, bottom in RATIOS]
    return [*ratios, counts["n_words"].cast("double").alias("n_words")]


@dataclass(frozen=True)
class Test:
    """``feature >= limit`` or ``feature < limit``."""

    feature: str
    at_least: bool
    limit: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, FEATURES.index(self.feature)]
        return column >= self.limit if self.at_least else column < self.limit

    def column(self, named: dict[str, Column]) -> Column:
        return named[self.feature] >= self.limit if self.at_least else named[self.feature] < self.limit


Rule = tuple[Test, ...]


def _covered(rule: Sequence[Test], values: np.ndarray) -> np.ndarray:
    held = np.ones(len(values), bool)
    for test in rule:
        held &= test.holds(values)
    return held


def _best_test(values: np.ndarray, bad: np.ndarray) -> tuple[float, Test | None]:
    """The test with the highest gain of information on the bad rows (FOIL's measure)."""
    p, n = bad.sum(), len(bad) - bad.sum()
    best, chosen = 1e-9, None
    before = np.log2(p / (p + n))
    for k, name in enumerate(FEATURES):
        order = np.argsort(values[:, k], kind="stable")
        column, hits = values[order, k], np.cumsum(bad[order])
        cuts = np.flatnonzero(np.diff(column) > 0)
        if not len(cuts):
            continue
        limits = (column[cuts] + column[cuts + 1]) / 2
        below_p, below = hits[cuts], cuts + 1
        for at_least, good, size in ((False, below_p, below), (True, p - below_p, len(bad) - below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(good > 0, good * (np.log2(good / size) - before), -np.inf)
            k_best = int(np.argmax(gain))
            if gain[k_best] > best:
                best, chosen = float(gain[k_best]), Test(name, at_least, float(limits[k_best]))
    return best, chosen


def _grow(values: np.ndarray, bad: np.ndarray, most: int) -> Rule:
    rule: list[Test] = []
    here_v, here_b = values, bad
    while len(rule) < most and here_b.any() and not here_b.all():
        _, test = _best_test(here_v, here_b)
        if test is None:
            break
        rule.append(test)
        held = test.holds(here_v)
        here_v, here_b = here_v[held], here_b[held]
    return tuple(rule)


def _worth(rule: Rule, values: np.ndarray, bad: np.ndarray) -> float:
    """(p - n) / (p + n) on rows that the rule was not grown on."""
    held = _covered(rule, values)
    p, n = int((held & bad).sum()), int((held & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(values: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_tests: int = 4, precision: float = 0.9, support: int = 3) -> list[Rule]:
    """An ordered list of rules that reject, by sequential covering.

    Each rule is grown on two thirds of the rows not yet covered, and pruned from its end on the last third. A rule is
    accepted while it is precise on all rows that it covers there and has support; covered rows then leave.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and bad[left].any():
        grow, prune = left & ~third, left & third
        rule = _grow(values[grow], bad[grow], most_tests)
        if not rule:
            break
        cuts = [rule[:k] for k in range(1, len(rule) + 1)]
        if bad[prune].any():
            rule = max(cuts, key=lambda r: (_worth(r, values[prune], bad[prune]), -len(r)))
        held = left & _covered(rule, values)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        if p < support or p < precision * (p + n):
            break
        rules.append(rule)
        left &= ~held
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, **how) -> list[Rule]:
    """Rules that tell quality 0 from quality 1, from at most ``most`` labelled documents.

    Several labels of one id count once (any 0 makes it 0); labels or ids that are null are left out. Without both
    kinds of label there are no rules. The bounded sample alone reaches the driver, as one row of numbers a document.
    """
    rows = labelled(docs, labels, most).toPandas().sort_values("doc_id")
    # A fixed shuffle, so that growing and pruning rows do not depend on the order of ids.
    rows = rows.iloc[np.random.default_rng(SEED).permutation(len(rows))]
    bad = rows["_quality"].to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn_rules(rows[FEATURES].to_numpy(float), bad, **how)


def labelled(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """doc_id, _quality and the features of the labelled documents that a fit looks at and that pass the base rules."""
    named = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    chosen = named.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(most)
    known = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id")
    counted = known.select("doc_id", "_quality", statistics(F.col("text")).alias("_c"))
    usable = counted.filter(~base_failed(F.col("_c")))
    one = usable.groupBy("doc_id", "_quality").agg(F.min(F.struct(*features(F.col("_c")))).alias("_f"))
    return one.select("doc_id", "_quality", "_f.*")


def verdict(counts: Column, rules: Sequence[Rule]) -> Column:
    """Place in the list of the first rule that rejects a document, from 1; 0 if none does."""
    named = dict(zip(FEATURES, features(counts), strict=True))
    chain = None
    for k, rule in enumerate(rules, 1):
        held = rule[0].column(named)
        for test in rule[1:]:
            held = held & test.column(named)
        chain = F.when(held, k) if chain is None else chain.when(held, k)
    return F.lit(0) if chain is None else chain.otherwise(0)


def judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """doc_id, the contract's counts, base_failed, kept and rule (0: none) of every row.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged alike. Other columns are not
    read; an empty table gives no rows.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text")).alias("_c"))
    failed = counted.select("doc_id", "_c", base_failed(F.col("_c")).alias("base_failed"), verdict(F.col("_c"), rules).alias("rule"))
    kept = ~F.col("base_failed") & (F.col("rule") == 0)
    return failed.select("doc_id", *[F.col("_c")[c].alias(c) for c in COUNTS[:5]], "base_failed", kept.alias("kept"), "rule")


def keep_good(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned ones, in the columns of ``docs``."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), statistics(F.col("text")).alias("_c"))
    return held.filter(~base_failed(F.col("_c")) & (verdict(F.col("_c"), rules) == 0)).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return judged(docs, fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
