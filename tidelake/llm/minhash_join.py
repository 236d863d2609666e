"""Near-duplicate documents by an inverted join of signature coordinates.

Every document is posted under its (coordinate, value) pairs. Two documents are candidates if they collide in at least ``MATCHES``
of ``COORDINATES`` coordinates. Such documents share a posting even if each leaves out its ``MATCHES - 1`` longest lists
(in one order of lists for all), so the merge skips those: lists that run through the corpus, as of a passage that
many texts quote, are read for the documents only that have little else. Candidates are confirmed on full shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidelake.llm.common import bytes_of, settle, small_side, table
from tidelake.llm.components import components

SHINGLE = 4
SIMILARITY = 80
COORDINATES = 48
#: Two sets of similarity 0.8 collide in 38 of 48 coordinates on average, in fewer than 24 about once in a million pairs.
MATCHES = 24
#: Rounds in which documents meet one member of each list's largest component before they meet them all.
ROUNDS = 3
#: Shingle sets that a confirming task holds, to save reading a text again.
HELD_SETS = 500
#: Bits of the parity sketch.
PARITIES = 1024
SEED = 991

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, each computed once; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_HASHES = _WordHashes()
_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles; of fewer words than ``size``, of the whole sequence."""
    words = text.lower().split()  # bytes: lower-cases A-Z and splits at the six white-space bytes only
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    rolled = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        rolled = _scramble(rolled + hashes[k : len(words) - size + 1 + k])
    return np.unique(rolled)


def signature(members: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash over a set, below the coordinate's number: one key per coordinate."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 8192):
        values = members[at : at + 8192, None] * _FACTORS[None, :] + _ADDENDS[None, :]
        least = np.minimum(least, (values >> np.uint64(32)).min(axis=0))
    return ((np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) | least).astype(np.int64)


def parities(members: np.ndarray) -> np.ndarray:
    """1024 bits: which hash residues a set holds an odd number of times.

    Two sets differ in at least as many members as their bits differ, so the bits rule out pairs without an error.
    """
    odd = np.bincount((members % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_LONGS = ArrayType(LongType())
_SET = StructType([StructField("n", LongType()), StructField("digest", BinaryType()), StructField("keys", _LONGS), StructField("odd", _LONGS)])


def _describe(size: int):
    @F.arrow_udf(_SET)
    def describe(texts: pa.Array) -> pa.Array:
        counts, digests, keys, odd = [], [], [], []
        for text in bytes_of(texts):
            members = shingles(text, size)
            counts.append(len(members))
            digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None)
            keys.append(signature(members) if len(members) else None)
            odd.append(parities(members) if len(members) else None)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
            ["n", "digest", "keys", "odd"],
        )

    return describe


def _confirm(size: int, similarity: int):
    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def of(node: int, text: bytes) -> np.ndarray:
            if node not in sets:
                if len(sets) > HELD_SETS:
                    sets.clear()
                sets[node] = shingles(text, size)
            return sets[node]

        for batch in batches:
            a, b, texts, others = batch.columns
            links = []
            for x, y, text, other in zip(a.to_pylist(), b.to_pylist(), bytes_of(texts), bytes_of(others), strict=True):
                mine, theirs = of(x, text), of(y, other)
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * common >= similarity * (len(mine) + len(theirs) - common):
                    links.append((x, y))
            columns = list(zip(*links, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return confirm


def _row_key(docs: DataFrame) -> list[Column]:
    """What tells rows apart: the id and a hash of the text. Rows equal in both are copies of one another."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key")]


class _Search:
    """The candidate search and confirmation over one table of distinct shingle sets (node, doc_id, text_key, n, keys, odd)."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, similarity: int):
        self.size, self.similarity = size, similarity
        posted = classes.select("node", F.explode("keys").alias("key"))
        lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
        shared = posted.join(lists, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("length", "key"))).alias("shared"))
        # Of the shortest COORDINATES - MATCHES + 1 lists of a document those with other members; lists of its own come first.
        first = F.size("shared") - (MATCHES - 1)
        prefix = F.transform(F.slice("shared", 1, F.greatest(first, F.lit(0))), lambda s: s["key"])
        chosen = shared.select("node", prefix.alias("prefix")).filter(F.size("prefix") > 0)
        held = settle(classes.join(chosen, "node"))
        self.active = held.drop("prefix")
        self.posted = held.select("node", F.explode("prefix").alias("key"))
        owners = self.active.select("node", "doc_id", "text_key")
        rows = docs.select(*_row_key(docs), F.col("text"))
        joined = rows.join(owners, rows["doc_id"].eqNullSafe(owners["doc_id"]) & (rows["text_key"] == owners["text_key"]))
        # Rows equal in id and text are copies: any one of them serves.
        self.texts = settle(joined.select("node", "text").dropDuplicates(["node"]))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those whose sets are similar: by length and parities, then by collisions, then on the full sets."""
        close = pairs.join(self._side("a", "n", "odd"), "a").join(self._side("b", "n", "odd"), "b").filter(self._close()).select("a", "b")
        return self.read(self.colliding(close))

    def colliding(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) those that collide often enough."""
        both = pairs.join(self._side("a", "keys"), "a").join(self._side("b", "keys"), "b")
        return settle(both.filter(F.size(F.array_intersect("keys_a", "keys_b")) >= MATCHES).select("a", "b"))

    def read(self, likely: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar."""
        mine = self.texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        other = self.texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        read = likely.join(mine, "a").join(other, "b").select("a", "b", "text_a", "text_b")
        return settle(read.mapInArrow(_confirm(self.size, self.similarity), "a long, b long"))

    def _side(self, name: str, *columns: str) -> DataFrame:
        return self.active.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def _close(self) -> Column:
        """Lengths and parities that similar sets can have."""
        n, m = F.col("n_a"), F.col("n_b")
        lengths = 100 * F.least(n, m) >= self.similarity * F.greatest(n, m)
        apart = sum((F.bit_count(F.col("odd_a")[i].bitwiseXOR(F.col("odd_b")[i])) for i in range(PARITIES // 64)), F.lit(0))
        parity = (100 + self.similarity) * apart <= (100 - self.similarity) * (n + m)
        return lengths & parity

    def star_pairs(self) -> DataFrame:
        """Each posting with the least node of its list."""
        hubs = self.posted.groupBy("key").agg(F.min("node").alias("b"))
        return self.posted.join(hubs, "key").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()

    def _mixed(self, roots: DataFrame, number: int) -> DataFrame:
        """Postings of the lists that hold several components, with their root, the list's largest component and a member of it."""
        placed = self.posted.join(small_side(roots), "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        member = F.min_by("node", F.xxhash64("node", "key", F.lit(number))).alias("member")
        groups = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"), member)
        major = groups.groupBy("key").agg(
            F.max_by(F.struct("root", "member"), F.struct("size", "root")).alias("major"), F.count(F.lit(1)).alias("groups")
        )
        return placed.join(major.filter("groups > 1").select("key", "major.member", F.col("major.root").alias("major")), "key")

    def member_pairs(self, roots: DataFrame, number: int) -> DataFrame:
        """Postings outside the largest component of their list, with another member of it in each list and round."""
        return self._mixed(roots, number).filter("root <> major").select(F.col("node").alias("a"), F.col("member").alias("b")).distinct()

    def crossing_pairs(self, roots: DataFrame) -> DataFrame:
        """All likely pairs of one list that are in different components so far.

        Pairs inside a component need no test: another link would change nothing. In each list the largest component faces
        the others, so a group that fills a list meets only the few that are not in it. A posting brings no more than its set's
        length and parities; the few pairs that these allow are made distinct before their signatures are fetched.
        """
        mixed = settle(self._mixed(roots, 0).select("key", "node", "root", "major"))
        minor = mixed.filter("root <> major").select("key", F.col("node").alias("a"), F.col("root").alias("root_a"))
        minor = minor.join(self._side("a", "n", "odd"), "a")
        against = mixed.select(F.col("key").alias("key_b"), "major", F.col("node").alias("b"), F.col("root").alias("root_b"))
        against = against.join(self._side("b", "n", "odd"), "b")
        apart = (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("major")) | (F.col("b") < F.col("a")))
        met = minor.join(against, (F.col("key") == F.col("key_b")) & apart & self._close()).select("a", "b").distinct()
        return self.colliding(met)


def near_groups(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of every row.

    Rows with equal sets are one class before anything is posted, so exact copies cost nothing more. Links are
    searched in rounds: each posting against the least member of its list, those that are left against one member
    of the largest component of each of their lists, and in the end every pair of a list whose members are not yet connected. component_id is the smallest id in the component, null ids last. Rows without words
    are linked with nothing and kept. Of several rows with the smallest id one text is kept; rows equal in id and
    text stay together. An empty table gives no rows; other columns are not read.
    """
    described = docs.select(*_row_key(docs), _describe(shingle)(F.col("text").cast("string")).alias("set"))
    rows = settle(described.select("doc_id", "text_key", F.col("set.n").alias("n"), F.col("set.digest").alias("digest"), F.col("set.keys").alias("keys"), F.col("set.odd").alias("odd")))
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_key")
    merged = rows.filter("n > 0").groupBy("digest", "n").agg(F.min(order).alias("first"), F.min("keys").alias("keys"), F.min("odd").alias("odd"))
    classes = settle(merged.select(F.monotonically_increasing_id().alias("node"), "digest", "n", "keys", "odd", "first", "first.doc_id", "first.text_key"))
    search = _Search(docs, classes.select("node", "doc_id", "text_key", "n", "keys", "odd"), shingle, similarity)

    roots = settle(components(search.confirmed(search.star_pairs())))
    for number in range(1, ROUNDS + 1):
        more = search.confirmed(search.member_pairs(roots, number)) if number < ROUNDS else search.read(search.crossing_pairs(roots))
        if not more.isEmpty():
            held = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))  # as good as the links that it stands for
            roots = settle(components(held.unionByName(more)))

    member = classes.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    heads = member.groupBy("root").agg(F.min("first").alias("head"))
    named = member.join(heads, "root").select("digest", "head")
    linked = rows.select("doc_id", "text_key", "n", "digest").join(named, "digest", "left")
    alone = F.col("head").isNull()
    kept = alone | (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key")))
    return linked.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"), kept.alias("kept")
    )


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """The kept rows of ``docs``, in its columns: one text of each group of near copies."""
    groups = near_groups(docs, shingle, similarity)
    gone = groups.filter("not kept").select("doc_id", "text_key").distinct()
    key = F.xxhash64("text") == gone["text_key"]
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & key, "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")
