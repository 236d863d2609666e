"""What each text filter does in every order of the filters, from counters that a stream corrects as it meets copies."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from hashlib import sha256
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelake import schemas
from tidelake.llm.common import bytes_of, settle, slices, table
from tidelake.operators import sizing
from tidelake.session import scratch
from tidelake.sources import tables

FILTERS = "ABCDE"
#: The bit of the filter that fails texts met under a smaller id; the others look at one text alone.
COPY = 1 << FILTERS.index("E")
GOOD, TOXIC = 1, 2
#: Micro-batches into which the files are dealt.
BATCHES = 4
SLICE = 4 << 20
#: Bytes of a text whose words are split at once; rows that a task combines at once.
CHUNK = 1 << 20
COMBINE = 100_000
#: Labels that a broadcast may hold: each micro-batch makes one of its own, and the driver holds several of them at a time.
broadcast_if_small = partial(sizing.broadcast_if_small, most=4 << 20)
#: Salts for ids with more than this part of all rows, where labels are too large to broadcast.
SALTS, HOT = 16, 1000
#: Rows of the documents to a partition of the state, and most partitions: each task of a stream tells the driver a number of every
#: partition (some 180 bytes), so what the driver gets grows with their square.
STORE_ROWS, MAX_STORES = 50_000, 1000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SYMBOL = re.compile(rb"[#$%&*|]")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Order among ids: present ones by value, then absent ones; LATE rows follow a smaller id of their text for certain.
PRESENT, ABSENT, LATE = 0, 1, 2
NARROW = "rank int, doc_id long, part string, mask int, high long, low long"
COMBINED = "bucket long, high long, low long, rank int, doc_id long, part string, mask int, label int, n long"
DELTAS = "part string, mask int, label int, n bigint"
#: Texts by their key, as compressed JSON: [high, low, rank, doc_id, [[part, label, number], ...]] with the smallest id met and the
#: rows that have it.
STATE = "texts binary"
#: Texts that one state holds on average: a call of the state function costs some milliseconds, a text some microseconds.
TEXTS = 256


def word_counts(raw: bytes) -> tuple[int, int]:
    """Words and distinct words of a text; a long one is split piece by piece, so only its distinct words are held."""
    if len(raw) <= CHUNK:
        words = raw.split()
        return len(words), len(set(words))
    number, seen, at = 0, set(), 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + CHUNK)
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()
        number += len(words)
        seen.update(words)
        at = end
    return number, len(seen)


def text_mask(raw: bytes, points: int) -> int:
    """Bits of the filters A to D that a text of so many code points fails."""
    words, distinct = word_counts(raw)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    fails = (words < 100, 100 * distinct < 80 * words, 100 * upper > 10 * points, _SYMBOL.search(raw) is not None)
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _masks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        texts = bytes_of(batch.column(2))
        points = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
        masks = [text_mask(raw, n) for raw, n in zip(texts, points, strict=True)]
        keys = np.frombuffer(b"".join([sha256(raw).digest()[:16] for raw in texts]), "<i8").reshape(-1, 2)
        ids = batch.column(0)
        rank = pc.if_else(pc.is_null(ids), ABSENT, PRESENT).cast(pa.int32())
        columns = [rank, pc.fill_null(ids, 0), batch.column(1), pa.array(masks, pa.int32()), pa.array(keys[:, 0]), pa.array(keys[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, names=["rank", "doc_id", "part", "mask", "high", "low"])


def text_masks(docs: DataFrame) -> DataFrame:
    """rank, doc_id, part, mask of the filters A to D, and 128 bits of the text's SHA-256 as its key, of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_masks, NARROW)


def label_flags(labels: DataFrame) -> DataFrame:
    """Of each labelled id with quality 1 or toxic 1 its flags; of several rows of one id any counts."""
    flag = F.bit_or(F.when(F.col("quality") == 1, GOOD).otherwise(0).bitwiseOR(F.when(F.col("toxic") == 1, TOXIC).otherwise(0)))
    flags = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_labelled")).agg(flag.alias("label"))
    return flags.filter("label > 0")


def hot_ids(docs: DataFrame, rows: int) -> list[int]:
    """Ids with more than a thousandth of the ``rows`` of the documents, so less than a thousand of them; only ids are read."""
    counts = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
    return [r["doc_id"] for r in counts.filter(F.col("count") * HOT > rows).select("doc_id").collect()]


def with_labels(rows: DataFrame, flags: DataFrame, salts: int = SALTS, hot: Callable[[], list[int]] = list) -> DataFrame:
    """``rows`` with their label, 0 if they have none. Settled flags measured small are broadcast; larger ones are shuffled.

    A stream's joins get no adaptive splitting, so flags of the ids that ``hot`` returns are repeated for ``salts`` parts of
    their rows, and rows without an id, which have no label, go anywhere.
    """
    present = F.col("rank") == PRESENT
    side = broadcast_if_small(flags)
    if side is flags:
        found = hot()
        dealt, copies = F.lit(0).cast("long"), F.lit(0).cast("long")
        if found:
            dealt = F.when(F.col("doc_id").isin(found), F.pmod("_draw", F.lit(salts))).otherwise(dealt)
            copies = F.when(F.col("_labelled").isin(found), F.lit(salts - 1).cast("long")).otherwise(copies)
        rows = rows.withColumn("_draw", (F.rand(0) * F.lit(1 << 40)).cast("long"))
        rows = rows.withColumns({"_id": F.when(present, F.col("doc_id")).otherwise(F.col("_draw")), "_salt": dealt})
        # the planner takes flags for as small as the files that they come from, and would broadcast them
        side = flags.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies))).hint("merge")
        same = (F.col("_id") == F.col("_labelled")) & (F.col("_salt") == F.col("_copy")) & present
    else:
        same = (F.col("doc_id") == F.col("_labelled")) & present
    return rows.join(side, same, "left").select("rank", "doc_id", "part", "mask", "high", "low", F.coalesce("label", F.lit(0)).alias("label"))


def _combine(buckets: int):
    """Rows of one text in a task: those of its smallest id there keep it, the others are counted as late."""
    names = ["high", "low", "rank", "doc_id", "part", "mask", "label"]

    def combined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).select(names).sort_by([(c, "ascending") for c in names[:4]])
        high, low, rank, ids = (rows[c].to_numpy() for c in names[:4])
        opens = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        first = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        late = (rank != rank[first]) | (ids != ids[first])
        rows = rows.set_column(2, "rank", pa.array(np.where(late, LATE, rank).astype(np.int32)))
        rows = rows.set_column(3, "doc_id", pa.array(np.where(late, 0, ids)))
        counted = rows.group_by(names).aggregate([([], "count_all")]).rename_columns([*names, "n"])
        bucket = pa.array(counted["high"].to_numpy().view(np.uint64) % np.uint64(buckets)).cast(pa.int64())
        yield from counted.add_column(0, "bucket", bucket).combine_chunks().to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= COMBINE:
                yield from combined(held)
                held, size = [], 0
        if size:
            yield from combined(held)

    return run


def _deltas(rows: list[tuple], before: tuple | None) -> tuple[Counter, tuple]:
    """Changes of the part counters by new ``rows`` (rank, doc_id, part, mask, label, n) of one text, and its new state.

    ``before`` is the state: (rank, doc_id, {(part, label): n}). Where a smaller id arrives, the rows of the earlier one are
    retracted from the counters of their mask and counted as copies.
    """
    deltas: Counter = Counter()
    mask = rows[0][3]  # the filters A to D see the text alone
    place, held = (before[:2], dict(before[2])) if before else ((LATE, 0), {})
    first = min([place, *[(rank, doc_id) for rank, doc_id, *_ in rows if rank != LATE]])
    if first != place:
        for (part, label), n in held.items():
            deltas[part, mask, label] -= n
            deltas[part, mask | COPY, label] += n
        held = {}
    for rank, doc_id, part, _, label, n in rows:
        if (rank, doc_id) == first:
            held[part, label] = held.get((part, label), 0) + n
            deltas[part, mask, label] += n
        else:
            deltas[part, mask | COPY, label] += n
    return deltas, (*first, held)


def _update(_bucket, frames: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The state of some texts whose keys fall into one bucket, each text by itself."""
    names = ["high", "low", "rank", "doc_id", "part", "mask", "label", "n"]
    rows: dict[tuple, list[tuple]] = {}
    for frame in frames:
        for high, low, *row in zip(*[frame[c].tolist() for c in names], strict=True):
            rows.setdefault((high, low), []).append(tuple(row))
    texts: dict[tuple, tuple] = {}
    for high, low, rank, doc_id, held in json.loads(zlib.decompress(state.get[0])) if state.exists else []:
        texts[high, low] = (rank, doc_id, {(part, label): n for part, label, n in held})
    total: Counter = Counter()
    for key, new in rows.items():
        deltas, texts[key] = _deltas(new, texts.get(key))
        for counter, n in deltas.items():
            total[counter] += n
    kept = [[*key, rank, doc_id, [[part, label, n] for (part, label), n in held.items()]] for key, (rank, doc_id, held) in texts.items()]
    state.update((zlib.compress(json.dumps(kept, separators=(",", ":")).encode(), 1),))
    yield pd.DataFrame([(*counter, n) for counter, n in total.items() if n], columns=["part", "mask", "label", "n"])


def stored_stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """A stream over the files of a Parquet table in about ``batches`` parts; the table is a folder or one file."""
    stored = spark.read.parquet(path)
    files = stored.inputFiles()
    reader = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", max(1, -(-len(files) // batches)))
    folder, _, name = path.rstrip("/").rpartition("/")
    if len(files) == 1 and files[0].endswith(f"/{name}"):  # streams read folders
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def store_partitions(rows: int, cores: int, most: int) -> int:
    """Partitions for a state of so many rows, ``most`` being what the session names."""
    return min(most, MAX_STORES, max(2 * cores, -(-rows // STORE_ROWS)))


def started(spark: SparkSession, partitions: int, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """A stream started with so many shuffle partitions. It keeps the settings of its start; the session's are put back."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, partitions)
    try:
        return start()
    finally:
        spark.conf.set(name, before)


def count_masks(spark: SparkSession, path: str, labels: DataFrame, root: str, batches: int = BATCHES) -> DataFrame:
    """part, mask, label and n: rows of the documents at ``path`` by the set of filters that they fail.

    A stream reads all files there are, in about ``batches`` micro-batches. Its state has every text by its key, some 256 texts a
    row and 40 bytes a text, in the store that the session names (``build_session``: RocksDB, beyond memory); copies are combined in
    their task before they meet it. The state has as many partitions as its rows need, within those that the session names. Each
    micro-batch writes its changes of the counters in place of
    those that it may have written before, so a replay after a failure changes nothing. The counters are their sum.
    """
    flags = settle(label_flags(labels))
    docs = spark.read.parquet(path)
    number = docs.count()  # from the files' footers
    masked = with_labels(text_masks(stored_stream(spark, path, batches)), flags, hot=lambda: hot_ids(docs, number))
    rows = masked.mapInArrow(_combine(max(1, number // TEXTS)), COMBINED)
    deltas = rows.groupBy("bucket").applyInPandasWithState(_update, DELTAS, STATE, "update", "NoTimeout")

    def add(batch: DataFrame, batch_id: int) -> None:
        changes = batch.groupBy("part", "mask", "label").agg(F.sum("n").alias("n"))
        tables.put_batch(changes, f"{root}/counters", str(batch_id))

    stream = deltas.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
    partitions = store_partitions(number, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    started(spark, partitions, stream.foreachBatch(add).trigger(availableNow=True).start).awaitTermination()
    counters = tables.read(spark, f"{root}/counters", tables.batched(schemas.struct(DELTAS)))
    return counters.groupBy("part", "mask", "label").agg(F.sum("n").alias("n")).filter("n <> 0")


def orders() -> list[dict]:
    """Every step of every order of the filters: the filter's bit and the bits of those applied before it."""
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(f) for f in order]
        out += [{"filter_order": "".join(order), "step": k + 1, "bit": bit, "before": sum(bits[:k])} for k, bit in enumerate(bits)]
    return out


def interactions(counters: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of ``audit``, from counters by part, mask and label.

    The masks of a part (at most 32) become one row; its steps come from a list of constants, so nothing is joined. A filter
    removes a document with k failed filters in 120 / k of the 120 orders: in those where it stands first among them.
    """
    good, toxic = (F.when(F.col("label").bitwiseAND(bit) > 0, F.col("n")).otherwise(0) for bit in (GOOD, TOXIC))
    by_mask = counters.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(good).alias("good"), F.sum(toxic).alias("toxic"))
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    step = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    steps = parts.select("part", "masks", F.explode(F.from_json(F.lit(json.dumps(orders())), step)).alias("s"))
    bit, before = F.col("s.bit"), F.col("s.before")

    def total(value, kept) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + F.when(kept(m["mask"]), value(m)).otherwise(0)).cast("long")

    fails, passed = (lambda m: m.bitwiseAND(bit) > 0), (lambda m: m.bitwiseAND(before) == 0)
    counts = {
        "kept": total(lambda m: m["n"], lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0),
        "removed": total(lambda m: m["n"], lambda m: fails(m) & passed(m)),
        "redundant": total(lambda m: m["n"], lambda m: fails(m) & ~passed(m)),
        "unique_fails": total(lambda m: m["n"], lambda m: m == bit),
        "good_lost": total(lambda m: m["good"], lambda m: fails(m) & passed(m)),
        "toxic_lost": total(lambda m: m["toxic"], lambda m: fails(m) & passed(m)),
        "shapley": total(lambda m: m["n"] * (F.lit(120) / F.bit_count(m["mask"])).cast("long"), fails),
    }
    return steps.select("part", "s.filter_order", "s.step", *[c.alias(name) for name, c in counts.items()])


def audit(spark: SparkSession, path: str, labels: DataFrame, root: str, batches: int = BATCHES) -> DataFrame:
    """What five filters do to the documents at ``path``, for each part (lang; null as empty), order and step.

    A null text is empty. Copies are rows whose whole text is that of a smaller doc_id, wherever it stands; rows that repeat
    an id and its text fail or pass together; a null id is larger than all others and equal to itself. Labels are those of
    ``labels`` by id; without one a row is neither good nor toxic. An empty table has no parts and gives no rows. Other
    columns are not read. What the stream keeps lies below ``root``.
    """
    return interactions(count_masks(spark, path, labels, root, batches))


def query(spark, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return audit(spark, f"{sf_dir}/documents.parquet", labels, scratch(spark, "filter-audit"))
