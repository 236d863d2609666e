"""Allow and block lists for URLs as Bloom filter cascades: exact membership for every key of the corpus, without a join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import ceil, log, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import settle, table

ALLOW, BLOCK = "allow", "block"

#: The rules (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Words between the dots and hyphens of a host that mark it as unwanted where no rule fits.
WORDS = """
    ad ads adult adults advert adverts bet bets betting bingo casino casinos escort escorts gambling hentai jackpot
    lottery malware nude nudes phishing pills poker porn porno sex sexy slots spam viagra warez webcams xxx
""".split()

#: Bytes of filters that the driver and each Python worker hold at a time.
MAX_BYTES = 64 << 20
#: Levels of a cascade, halving each second one: more are needed only if two keys agree in 128 bits of hashes.
MAX_LEVELS = 128
SEEDS = (0x5EED, 0xF00D)
_GOLDEN = 0x9E3779B97F4A7C15


def hashes(key: Column) -> Column:
    """Two 64-bit hashes of a key."""
    return F.struct(*[F.xxhash64(F.lit(seed), key).alias(f"h{k}") for k, seed in enumerate(SEEDS)])


def _mixed(x: np.ndarray, level: int) -> np.ndarray:
    """Other 64 bits for each level (a multiply-shift finaliser)."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((_GOLDEN * (level + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Filter:
    """One Bloom filter: ``bits`` places, ``probes`` of them for a key."""

    level: int
    bits: int
    probes: int
    words: np.ndarray = field(repr=False, default_factory=lambda: np.zeros(0, np.uint64))

    def places(self, h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
        """The places of each key, a row of them for each key."""
        first, step = _mixed(h0.astype(np.uint64), self.level), _mixed(h1.astype(np.uint64), self.level) | np.uint64(1)
        with np.errstate(over="ignore"):
            steps = first[:, None] + step[:, None] * np.arange(self.probes, dtype=np.uint64)
        return steps % np.uint64(self.bits)

    def holds(self, h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
        at = self.places(h0, h1)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def sized_filter(level: int, keys: int, rate: float) -> Filter:
    """An empty filter for so many keys and this rate of false positives."""
    bits = max(64, ceil(keys * log2(1 / rate) / log(2)))
    return Filter(level, -(-bits // 64) * 64, max(1, round(log2(1 / rate))))


def member(filters: list[Filter], h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """Which keys are listed. The first filter that lacks a key decides: one of the odd places in the cascade says no, one of the
    even places yes. A key that all filters hold is listed if their number is odd."""
    listed = np.full(len(h0), len(filters) % 2 == 1)
    open_ = np.arange(len(h0))
    for k, level in enumerate(filters):
        held = level.holds(h0[open_], h1[open_])
        listed[open_[~held]] = k % 2 == 1
        open_ = open_[held]
    return listed


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h0", "h1"))


def _fill(keys: DataFrame, empty: Filter) -> Filter:
    """The filter with all ``keys`` (h0, h1) in it: words are combined in each task, then over tasks. Only words come to the driver."""

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(empty.places(*_hashed(batch)).ravel())
            word, first = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
            if len(word):
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    made = keys.select("h0", "h1").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    full = np.zeros(empty.bits // 64, np.uint64)
    full[made["word"].to_numpy()] = made["bits"].to_numpy().view(np.uint64)
    return Filter(empty.level, empty.bits, empty.probes, full)


def _passing(keys: DataFrame, level: Filter) -> DataFrame:
    """The ``keys`` that a filter holds."""
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.holds(*_hashed(batch))))

    return keys.select("h0", "h1").mapInArrow(run, "h0 long, h1 long")


def build_cascade(keys: DataFrame) -> list[Filter]:
    """A cascade that is exact for all ``keys`` (h0, h1, listed), each once.

    The first filter holds the listed keys, each further one the keys of the other side that the one before let through, until
    none are left. Rates follow from the numbers: the first filter lets about as many others through as there are listed keys, the
    others half of what they see. Every level is a pass over keys that the level before let through.
    """
    mine = settle(keys.filter("listed").select("h0", "h1"))
    others = keys.filter("NOT listed").select("h0", "h1")
    filters: list[Filter] = []
    n_mine, n_others = mine.count(), others.count()
    rate = min(0.5, sqrt(0.5) * n_mine / n_others) if n_mine and n_others else 0.5
    while n_mine:
        if len(filters) == MAX_LEVELS:
            raise ValueError("a listed key and another one have equal hashes")
        filters.append(_fill(mine, sized_filter(len(filters), n_mine, rate)))
        mine, others = settle(_passing(others, filters[-1])), mine
        n_mine, rate = mine.count(), 0.5
    return filters


#: What a key begins with: a rule's host and path, or a word.
RULE, WORD = "r:", "w:"


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of all rules and words that could fit a URL: for each shape (labels of a rule's host, characters of its
    path) the host's last labels with the path's first characters, and the words between the host's dots and hyphens."""
    labels = F.split(host, r"\.", -1)
    keys = []
    for count, length in shapes:
        enough = (F.size(labels) >= count) & (F.length(path) >= length) & (host != "")
        suffix = F.array_join(F.slice(labels, -count, count), ".")
        keys.append(F.when(enough, F.concat(F.lit(RULE), suffix, F.substring(path, 1, length))))
    rules = F.array(*keys) if keys else F.array().cast("array<string>")
    words = F.filter(F.split(host, r"[.\-]", -1), lambda w: w != "")
    return F.array_distinct(F.array_compact(F.concat(rules, F.transform(words, lambda w: F.concat(F.lit(WORD), w)))))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    after = F.when(url.contains("://"), F.substr(url, F.length(F.substring_index(url, "://", 1)) + 4))
    host = F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def split_urls(pages: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """page_id, host, path and keys of every page."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes))


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels of host, characters of path) of the rules: a few, however many rules there are."""
    shapes = rules.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("length")).distinct()
    return sorted((r.labels, r.length) for r in shapes.collect())


def listed_keys(rules: DataFrame, words: DataFrame) -> DataFrame:
    """key and side of every rule and word. A rule on both sides blocks, and so do words."""
    side = F.when(F.col("verdict") == ALLOW, ALLOW).otherwise(BLOCK)
    of_rules = rules.select(F.concat(F.lit(RULE), "host", "path").alias("key"), side.alias("side"))
    of_words = words.select(F.concat(F.lit(WORD), "word").alias("key"), F.lit(BLOCK).alias("side"))
    return of_rules.unionByName(of_words).groupBy("key").agg(F.max("side").alias("side"))


def cascade_bytes(listed: int, others: int) -> int:
    """About what a cascade takes: the first filter by its rate, the others together less than 8 bits a listed key."""
    return ceil(listed * (8 + 1.5 * max(1.0, log2(max(others, 1) / max(listed, 1)) + 1)) / 8)


_HELD = "page_id long, host string, path string, keys array<struct<key:string,h0:bigint,h1:bigint>>"


def _find(sent, rounds: int, turn: int):
    """Adds the keys of each row that a cascade of ``sent`` lists, of those keys whose turn it is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("keys"))
            names, *both = keys.flatten().flatten()
            h0, h1 = (c.to_numpy(zero_copy_only=False).view(np.uint64) for c in both)
            row = np.repeat(np.arange(len(keys)), np.diff(keys.offsets.to_numpy()))
            due = np.flatnonzero(h0 & np.uint64(rounds - 1) == np.uint64(turn))
            found = []
            for side in (ALLOW, BLOCK):
                hit = due[member(sent.value[side], h0[due], h1[due])]
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=len(keys)))])
                found.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(hit))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "_allow", "_block"])

    return run


def judge(pages: DataFrame, rules: DataFrame, words: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` (verdict, host, path): a rule fits its host and the hosts below it, if the path starts with the rule's; of
    several the longest wins (host and path together, then the longer host). ``words`` (word): where no rule fits, a
    host with one of these between its dots and hyphens is blocked, any other URL allowed. A null URL, or one
    without ``://``, has an empty host and path, which no rule fits. Repeated rows are judged one by one. Rules and words may
    repeat; those with nulls or without a host are left out. An empty table gives no rows. Other columns are not read.

    The key universe is every key that a rule or word fitting some URL could have, each once. Two cascades, of the
    allowed and of the blocked keys among them, are exact for it, so the pages are judged without a join. Cascades are broadcast
    within ``most`` bytes; larger lists go through in rounds, each with the cascades of a part of the keys.
    """
    rules = rules.dropna(subset=["verdict", "host", "path"]).filter("host <> ''")
    urls = split_urls(pages, rule_shapes(rules))
    listed = listed_keys(rules, words.dropna(subset=["word"]))
    seen = urls.select(F.explode("keys").alias("key")).distinct().select("key", F.lit(None).cast("string").alias("side"), F.lit(True).alias("seen"))
    both = seen.unionByName(listed.select("key", "side", F.lit(False).alias("seen")))
    universe = both.groupBy("key").agg(F.max("side").alias("side"), F.max("seen").alias("seen")).filter("seen")
    universe = settle(universe.select("side", hashes(F.col("key")).alias("h")).select("side", "h.*"))
    count = {r["side"]: r["count"] for r in universe.groupBy("side").count().collect()}
    everything = sum(count.values())
    size = sum(cascade_bytes(count.get(side, 0), everything - count.get(side, 0)) for side in (ALLOW, BLOCK))
    rounds = 1 << max(0, ceil(log2(max(1, size / most))))

    keyed = F.transform("keys", lambda k: F.struct(k.alias("key"), hashes(k)["h0"].alias("h0"), hashes(k)["h1"].alias("h1")))
    none = F.array().cast("array<string>")
    rows = urls.select("page_id", "host", "path", keyed.alias("keys"), none.alias(ALLOW), none.alias(BLOCK))
    for turn in range(rounds):
        own = universe.filter(F.col("h0").bitwiseAND(rounds - 1) == turn)
        listed_on = {side: F.coalesce(F.col("side") == side, F.lit(False)).alias("listed") for side in (ALLOW, BLOCK)}
        cascades = {side: build_cascade(own.select("h0", "h1", c)) for side, c in listed_on.items()}
        sent = pages.sparkSession.sparkContext.broadcast(cascades)
        kinds = f"{_HELD}, {ALLOW} array<string>, {BLOCK} array<string>, _allow array<string>, _block array<string>"
        found = rows.mapInArrow(_find(sent, rounds, turn), kinds)
        rows = found.select("page_id", "host", "path", "keys", F.concat(ALLOW, "_allow").alias(ALLOW), F.concat(BLOCK, "_block").alias(BLOCK))
        if rounds > 1:  # the cascades of one round at a time
            rows = settle(rows)
            sent.destroy()

    def fitting(side: str) -> Column:
        rule = F.filter(side, lambda k: k.startswith(RULE))
        text = F.transform(rule, lambda k: F.substr(k, F.lit(len(RULE) + 1)))
        host = lambda k: F.length(F.substring_index(k, "/", 1))
        return F.transform(text, lambda k: F.struct(F.length(k).alias("length"), host(k).alias("host"), k.alias("rule"), F.lit(side).alias("side")))

    best = F.array_max(F.concat(fitting(ALLOW), fitting(BLOCK)))
    unwanted = F.exists(BLOCK, lambda k: k.startswith(WORD))
    verdict = F.coalesce(F.col("best.side"), F.when(F.col("unwanted"), BLOCK).otherwise(ALLOW))
    judged = rows.select("page_id", "host", "path", best.alias("best"), unwanted.alias("unwanted"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    words = spark.createDataFrame([(w,) for w in WORDS], "word string")
    return judge(table(spark, sf_dir, "pages", "page_id", "url"), rules, words)
