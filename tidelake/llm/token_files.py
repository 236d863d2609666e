"""Token ids of a corpus in files of Simple-8b blocks, in ascending order of documents, and their reader."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.llm import simple8b
from tidelake.llm.chunk_cache import ChunkCache
from tidelake.llm.common import slices, table, texts_of
from tidelake.session import scratch

END = 0
#: Ids that a row of a file holds, unless one document has more.
ROW_IDS = 1 << 18
SLICE = 4 << 20
#: Pieces that the library gets in one text.
LINES = 2_000
#: White space inside or at the end of a piece, or nothing but a space.
_BROKEN = re.compile(r"(?!^ \S)\s")
#: Documents per output partition at most, on average.
PER_PARTITION = 200_000
ROW = "part int, at long, doc_ids array<long>, n_tokens array<long>, payload binary"


class LibraryIds:
    """Ids as the ``tokenizers`` library gives them for whole texts.

    The file's splitter never joins text over a space between two characters that are no white space, so pieces between
    such spaces are encoded once each and looked up after that. A text that holds the string of an added token
    goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        # The model's own table costs more than it saves where every word comes once.
        model = self.model.model
        model._resize_cache(0) if hasattr(model, "_resize_cache") else None
        self.model.model = model
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.cache = ChunkCache(self._encode, 500_000)

        self.between = self.model.encode("\n", add_special_tokens=False).ids

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. Pieces without line ends go through the library many at a time, one a line.

        The splitter makes a line end between two characters that are no white space a match of its own, so the library gives
        the ids of the lines with one id between them.
        """
        out: list[bytes] = [b""] * len(pieces)
        lines = [i for i, p in enumerate(pieces) if p and len(self.between) == 1 and len(p) < 200 and not _BROKEN.search(p)]
        alone = sorted(set(range(len(pieces))) - set(lines))
        for i, e in zip(alone, self.model.encode_batch_fast([pieces[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        joined = ["\n".join(pieces[i] for i in lines[at : at + LINES]) for at in range(0, len(lines), LINES)]
        for at, e in enumerate(self.model.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.between[0]), len(ids)).tolist()
            own = lines[at * LINES : (at + 1) * LINES]
            if len(ends) != len(own):  # another splitter: give it the pieces one by one
                each = self.model.encode_batch_fast([pieces[i] for i in own], add_special_tokens=False)
                out_of = [np.array(e.ids, "<u4").tobytes() for e in each]
            else:
                out_of = [ids[start:end].tobytes() for start, end in zip([0, *(end + 1 for end in ends)], ends, strict=False)]
            for i, coded in zip(own, out_of, strict=True):
                out[i] = coded
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        whole = [any(a in text for a in self.added) for text in texts]
        split = iter(self.cache.ids([t for t, w in zip(texts, whole, strict=True) if not w]))
        return [self._encode([t])[0] if w else next(split) for t, w in zip(texts, whole, strict=True)]


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


def _rows(path: str, end: int, row_ids: int):
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    tail = np.array([end], "<u4").tobytes()

    def row(part: int, at: int, docs: list, coded: list[bytes]) -> pa.RecordBatch:
        payload = simple8b.encode(np.frombuffer(b"".join(coded), "<u4"))
        values = [[part], [at], [docs], [[len(c) // 4 for c in coded]], [payload]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "at", "doc_ids", "n_tokens", "payload"])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, model = TaskContext.get().partitionId(), library_ids(path)
        at, held, docs, coded = 0, 0, [], []
        for batch in slices(batches, "text", SLICE):
            for doc_id, ids in zip(batch.column(0).to_pylist(), model.ids(texts_of(batch.column(1))), strict=True):
                docs.append(doc_id)
                coded.append(ids + tail)
                held += len(coded[-1]) // 4
                if held >= row_ids:
                    yield row(part, at, docs, coded)
                    at, held, docs, coded = at + held, 0, [], []
        if docs:
            yield row(part, at, docs, coded)

    return encode


def write_ids(docs: DataFrame, tokenizer: str, path: str, end: int = END, row_ids: int = ROW_IDS) -> None:
    """Write the ids of every text, each followed by ``end``, in ascending order of doc_id.

    The files are Parquet files as containers, so that Spark commits them: a lost executor or a second attempt leaves nothing behind.
    A row holds whole documents: its place in its partition, the documents' ids and lengths, and their token
    ids as one Simple-8b array. Partitions are ranges of (doc_id, hash of the text), null ids first; rows with the same id
    are ordered by that hash. Null texts are empty and have the end id alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-count // PER_PARTITION), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.withColumn("_tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    ordered.mapInArrow(_rows(tokenizer, end, row_ids), ROW).write.mode("overwrite").parquet(path)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for at, doc_ids, sizes, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = simple8b.decode(payload).astype("<u4")
            ends = np.cumsum(np.array(sizes, np.int64))
            sums = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes, strict=True)]
            columns = [doc_ids, (at + ends - sizes).tolist(), sizes, sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of ``write_ids``.

    A partition's first id number is a sum over the partitions before it (one row each); no document is moved for it.
    """
    stored = spark.read.schema(ROW).parquet(path)
    sizes = stored.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # One row of two numbers per partition of the writing job: bounded by the number of its tasks.
    placed = stored.join(F.broadcast(firsts), "part")
    rows = placed.select((F.col("first") + F.col("at")).alias("at"), "doc_ids", "n_tokens", "payload")
    return rows.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the ids to files (in the shared folder unless ``path`` is given), and read the documents' digests back."""
    path = path or scratch(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer, path)
    return read_ids(docs.sparkSession, path)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
