"""Byte-level BPE in DuckDB, a database in each task's process: a recursive query encodes, an ordered aggregate decodes."""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tidelake.llm.chunk_cache import ChunkCache
from tidelake.llm.common import slices, table, texts_of

#: Bytes of text per round, bytes of distinct words per recursive query, tokens per decoding query; each bounds what DuckDB holds.
SLICE = 4 << 20
WORD_BYTES = 250_000
TOKENS = 500_000
#: Bytes of a word beyond which it is contracted outside the database: a step there reads the whole word.
LONG_WORD = 1024
MEMORY = "200MB"
#: Pieces held, twice: what a worker keeps between slices.
PIECES = 500_000
#: The same four beside whole rows, and beside what earlier stages have left in the executor: a worker gets by on less there.
FEW, FEW_WORD_BYTES, FEW_TOKENS, FEW_PIECES = 512 << 10, 80_000, 100_000, 60_000

# A token-position row is (word w, place p of its first byte, token t, the token nt after it, that one's place q, and the rank k of the
# merge of both, if there is one). A step takes the least (rank, place) of each word: the row there goes, the row behind it takes its
# place with the merged token, and the row before it gets a new successor. Only those two look up their merge again, the rank of
# every other row stays. Words without a merge leave the recursion.
_STEP = """
WITH RECURSIVE step(w, p, t, nt, q, k, live) AS (
  SELECT w, p, t, nt, p + 1, m, true FROM seed LEFT JOIN merges ON l = t AND r = nt
  UNION ALL
  (WITH best AS (
     SELECT w, min((k::BIGINT << 32) | p) AS b, arg_min(q, (k::BIGINT << 32) | p) AS bq FROM step WHERE live GROUP BY w),
   moved AS (
     SELECT step.w, CASE WHEN p = bq THEN (b & 4294967295)::INTEGER ELSE p END AS p, CASE WHEN p = bq THEN (b >> 32)::INTEGER ELSE t END AS t,
            CASE WHEN q = (b & 4294967295) THEN (b >> 32)::INTEGER ELSE nt END AS nt, q, k,
            p = bq OR q = (b & 4294967295) AS changed, b IS NOT NULL AS live
     FROM step JOIN best ON best.w = step.w WHERE step.live AND (b IS NULL OR p <> (b & 4294967295)))
   SELECT w, p, t, nt, q, CASE WHEN changed THEN m ELSE k END, live
   FROM moved LEFT JOIN merges ON l = CASE WHEN changed THEN t END AND r = nt)
)
SELECT w, list(t ORDER BY p) AS ids FROM step WHERE NOT live GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT d, unhex(array_to_string(list(h ORDER BY p), '')) AS bytes FROM tokens JOIN vocabulary USING (t) GROUP BY d ORDER BY d
"""


class Bpe:
    """The tables of a rank file in a database of this process, and a bounded table of words already encoded."""

    def __init__(self, path: str, pattern: str, pieces: int = PIECES, word_bytes: int = WORD_BYTES, tokens: int = TOKENS):
        self.word_bytes, self.tokens = word_bytes, tokens
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        ranks = self.ranks
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = (np.array(c, np.int32) for c in zip(*merges, strict=True))
        self.pairs: dict[tuple[int, int], int] = {}
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.db.register("new", pa.table({"l": left, "r": right, "m": merged}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM new")
        for kind in ("allocator_flush_threshold", "allocator_bulk_deallocation_flush_threshold"):
            self.db.execute(f"SET {kind} = '4MB'")  # memory of a query goes back after it
        self.db.register("new", pa.table({"t": np.array(list(ranks.values()), np.int32), "h": [t.hex() for t in ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM new")
        self.db.unregister("new")
        self.words: dict[str, bytes] = {}
        self.cache = ChunkCache(self._encode_pieces, pieces)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian 32-bit integers."""
        return self.cache.ids(texts)

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        matches = [self.pattern.findall(piece) for piece in pieces]
        self.words = {}  # those of one call: the pieces are what is held
        self._learn({word for words in matches for word in words})
        return [b"".join([self.words[word] for word in words]) for words in matches]

    def _learn(self, words: set[str]) -> None:
        open_words: list[tuple[str, bytes]] = []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:  # a word that is a token is that token, whether merges lead to it or not
                self.words[word] = np.array([rank], "<u4").tobytes()
            elif len(raw) > LONG_WORD:
                self.words[word] = self._long(raw)
            else:
                open_words.append((word, raw))
        open_words.sort(key=lambda pair: len(pair[1]))  # words of like lengths take like numbers of steps
        part, size = [], 0
        for pair in [*open_words, None]:
            if part and (pair is None or size + len(pair[1]) > self.word_bytes):
                for (word, _), ids in zip(part, self._recurse([raw for _, raw in part]), strict=True):
                    self.words[word] = ids
                part, size = [], 0
            if pair:
                part.append(pair)
                size += len(pair[1])

    def _recurse(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tokens = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes)
        place = (np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)).astype(np.int32)
        after = np.append(tokens[1:], np.int32(-1))
        after[ends - 1] = -1  # no token has this id, so the last one of a word has no merge
        self.db.register("seed", pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "p": place, "t": tokens, "nt": after}))
        found = self.db.sql(_STEP).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("seed")
        flat, ends = found.values.to_numpy().astype("<u4"), found.offsets.to_numpy()
        return [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _long(self, raw: bytes) -> bytes:
        """The same contractions of one long word, with its pairs in a heap: a step per pair would read the word again."""
        tokens = self.bytes[np.frombuffer(raw, np.uint8)].tolist()
        size = len(tokens)
        if not self.pairs:
            self.pairs = {(a, b): m for a, b, m in self.db.sql("SELECT l, r, m FROM merges").fetchall()}
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs = self.pairs
        heap = [(m, p, tokens[p], tokens[p + 1]) for p in range(size - 1) if (m := pairs.get((tokens[p], tokens[p + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            merged, p, left, right = heapq.heappop(heap)
            q = after[p]
            if tokens[p] != left or q >= size or tokens[q] != right:
                continue  # one of the two is gone
            tokens[p], tokens[q], after[p] = merged, -1, after[q]
            if after[p] < size:
                before[after[p]] = p
            for at in (before[p], p):
                if at >= 0 and after[at] < size:
                    both = tokens[at], tokens[after[at]]
                    if (m := pairs.get(both)) is not None:
                        heapq.heappush(heap, (m, at, *both))
        return np.array([t for t in tokens if t >= 0], "<u4").tobytes()

    def texts(self, coded: list[bytes]) -> list[bytes]:
        """The bytes that each document's ids stand for."""
        out: list[bytes] = []
        at = 0
        while at < len(coded):
            size, to = len(coded[at]) // 4, at + 1
            while to < len(coded) and size + len(coded[to]) // 4 <= self.tokens:
                size += len(coded[to]) // 4
                to += 1
            out += self._decode(coded[at:to])
            at = to
        return out

    def _decode(self, coded: list[bytes]) -> list[bytes]:
        flat = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
        sizes = [len(c) // 4 for c in coded]
        out = [b""] * len(coded)
        parts: dict[int, list[bytes]] = {}
        document = np.repeat(np.arange(len(coded), dtype=np.int32), sizes)
        for at in range(0, len(flat), self.tokens):  # a document beyond the bound is decoded in consecutive parts
            to = at + self.tokens
            self.db.register("tokens", pa.table({"d": document[at:to], "p": np.arange(len(flat[at:to]), dtype=np.int32), "t": flat[at:to]}))
            for d, text in self.db.sql(_DECODE).fetchall():
                parts.setdefault(d, []).append(text)
            self.db.unregister("tokens")
        for d, texts in parts.items():
            out[d] = b"".join(texts)
        return out


@lru_cache(maxsize=2)
def bpe(path: str, pattern: str, *bounds: int) -> Bpe:
    return Bpe(path, pattern, *bounds)


def _run(path: str, pattern: str):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern)
        for batch in slices(batches, "text", SLICE):
            coded = model.ids(texts_of(batch.column(1)))
            decoded = [hashlib.sha256(text).hexdigest() for text in model.texts(coded)]
            columns = [batch.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row.

    Null and empty texts have no tokens and the digests of no bytes. Repeated rows are encoded one by one (each
    distinct word once). Other columns are not read; an empty table gives no rows. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_run(path, pattern), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


ADDED = StructType([StructField("token_ids", BinaryType()), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


def _add(path: str, pattern: str, column: str):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path, pattern, FEW_PIECES, FEW_WORD_BYTES, FEW_TOKENS)
        try:
            for part in slices(batches, column, FEW):  # ids and texts of one slice at a time
                pa.default_memory_pool().release_unused()
                coded = model.ids(texts_of(part.column(part.schema.get_field_index(column))))
                decoded = [hashlib.sha256(text).hexdigest() for text in model.texts(coded)]
                columns = [pa.array(coded, pa.binary()), pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array(decoded)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *ADDED.names])
        finally:  # Spark goes on with the same process for other stages
            del model
            bpe.cache_clear()
            gc.collect()
            pa.default_memory_pool().release_unused()

    return add


def with_tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with the token ids of each text (little-endian 32-bit integers), their number, and digests of the ids and of the text
    decoded from them. Columns of ``docs`` that have these names are replaced. Null texts stay null and have no tokens; repeated rows
    stay; no rows give no rows. A task holds the ids and texts of one slice of some megabytes, or of one longer document."""
    kept = [f for f in docs.schema.fields if f.name not in ADDED.names]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    return rows.mapInArrow(_add(path, pattern, "text"), StructType([*kept, *ADDED.fields]))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
