"""Token counts of a sentence-piece BPE model, with huge documents encoded in overlapping chunks.

A place between two characters is stable if no piece of the vocabulary holds these two characters next to each other:
merging only ever joins neighbours into pieces, so no token crosses that place whatever stands around it, and both sides
are encoded independently. Chunks overlap around such places. Where the planned overlap holds none, it is widened,
up to the whole document. Both chunks of an overlap report their token boundaries at stable places with counts, and are
spliced at the first one they share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidelake.llm.common import slices, table, texts_of

LIMIT = 4096
#: Code points per chunk and on either side of a cut; a document of up to one chunk is encoded whole.
CHUNK = 32_768
OVERLAP = 256
#: Bytes of text that go through the library at once.
SLICE = 8 << 20


class Counter:
    """A loaded model and the character pairs that its pieces hold."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_byte(i))
        self.pairs = {piece[k : k + 2] for piece in pieces for k in range(len(piece) - 1)}

    def stable(self, text: str, at: int) -> bool:
        """No token of any text with these neighbours crosses the place before ``text[at]``."""
        pair = text[at - 1 : at + 1].replace(" ", "▁")
        return pair not in self.pairs

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []

    def boundaries(self, text: str) -> tuple[int, dict[int, int]]:
        """The number of tokens of a chunk, and at each stable place that ends a token, the tokens before it."""
        pieces = self.model.encode(text, return_type="proto").pieces
        # Offsets count bytes; characters begin at bytes that do not continue one.
        begins = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        before = {}
        for k, piece in enumerate(pieces, 1):
            if piece.begin < piece.end:  # of the byte tokens of one character only the last one has an extent
                end = int(begins[piece.end - 1])
                if end < len(text) and self.stable(text, end):
                    before[end] = k
        return len(pieces), before


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def plan_chunks(text: str, model: Counter, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """Chunks (from, to, left, right) of a text: the chunk, and how far its overlaps reach into it from either end.

    A cut gets the planned overlap on both sides, or twice it, and so on until there is a stable place inside.
    Cuts whose overlap would meet the one before are left out.
    """
    size, cuts, at, reached = len(text), [], chunk, 0
    while at < size:
        wide = overlap
        while at - wide > reached and at + wide < size and not any(model.stable(text, i) for i in range(at - wide + 1, at + wide)):
            wide *= 2
        low, high = at - wide, at + wide
        if low > reached and high < size and any(model.stable(text, i) for i in range(low + 1, high)):
            cuts.append((low, high))
            reached = high
        at += chunk
    ends = [(0, 0), *cuts, (size, size)]
    return [(a[0], b[1], a[1] - a[0], b[1] - b[0]) for a, b in zip(ends, ends[1:], strict=False)]


_CHUNKS = "uid long, doc_id long, n_bytes long, chunk int, first long, left_to long, right_from long, last boolean, piece string"
_EDGES = "uid long, doc_id long, n_bytes long, edge int, tokens long, after map<long,long>, before map<long,long>"


def _cut(path: str, chunk: int, overlap: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in slices(batches, "text", SLICE):
            for uid, doc_id, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plan = plan_chunks(text, model, chunk, overlap)
                rows = [(uid, doc_id, n_bytes, i, low, low + left, high - right, i == len(plan) - 1, text[low:high])
                        for i, (low, high, left, right) in enumerate(plan)]
                for at in range(0, len(rows), 64):
                    columns = zip(*rows[at : at + 64], strict=True)
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["uid", "doc_id", "n_bytes", "chunk", "first", "left_to", "right_from", "last", "piece"])

    return cut


def _encode(path: str):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.map_(pa.int64(), pa.int64()), pa.map_(pa.int64(), pa.int64())]
    names = ["uid", "doc_id", "n_bytes", "edge", "tokens", "after", "before"]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in slices(batches, "piece", SLICE):
            rows = []
            for uid, doc_id, n_bytes, chunk, first, left_to, right_from, last, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total, before = model.boundaries(piece)
                places = [(first + at, n) for at, n in before.items()]
                if chunk:  # what this chunk has counted of the overlap with the one before it
                    rows.append((uid, doc_id, n_bytes, chunk - 1, 0, None, [(at, n) for at, n in places if at < left_to]))
                after = None if last else [(at, total - n) for at, n in places if at > right_from]
                rows.append((uid, doc_id, n_bytes, chunk, total, after, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return encode


def _count(path: str):
    @F.arrow_udf(LongType())
    def count(texts: pa.Array) -> pa.Array:
        model, out = counter(path), []
        for part in slices([pa.RecordBatch.from_arrays([texts], names=["t"])], "t", SLICE):
            out += model.counts(texts_of(part.column(0)))
        return pa.array(out, pa.int64())

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and ids are counted one by one. Other columns
    are not read; an empty table gives no rows. Every chunk of a huge text is a row of its own, spread over all tasks.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce("text", F.lit("")).alias("text"),
    )
    huge = F.length("text") > chunk
    whole = rows.filter(~huge).select("doc_id", "n_bytes", _count(path)(F.col("text")).alias("n_tokens"))
    chunks = rows.filter(huge).mapInArrow(_cut(path, chunk, overlap), _CHUNKS)
    edges = chunks.repartition("uid", "chunk").mapInArrow(_encode(path), _EDGES)
    edge = edges.groupBy("uid", "doc_id", "n_bytes", "edge").agg(
        F.sum("tokens").alias("tokens"), F.first("after", ignorenulls=True).alias("after"), F.first("before", ignorenulls=True).alias("before")
    )
    shared = F.array_min(F.array_intersect(F.map_keys("after"), F.map_keys("before")))
    twice = F.col("after")[shared] + F.col("before")[shared]
    checked = F.when(F.col("after").isNull(), F.lit(0).cast("long")).when(shared.isNotNull(), twice)
    checked = checked.otherwise(F.raise_error(F.lit("chunks share no stable boundary")).cast("long"))
    spliced = edge.select("uid", "doc_id", "n_bytes", (F.col("tokens") - checked).alias("tokens"))
    summed = spliced.groupBy("uid", "doc_id", "n_bytes").agg(F.sum("tokens").alias("n_tokens")).drop("uid")
    return whole.unionByName(summed).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
