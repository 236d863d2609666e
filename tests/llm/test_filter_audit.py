import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tidelake.llm import filter_audit
from tidelake.session import scratch

LABELS = "doc_id long, quality int, toxic int"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
    return out


def brute(docs, labels):
    """Every order applied to every row, one filter after the other."""
    first, flags = {}, {}
    for doc_id, _, text in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    for doc_id, quality, toxic in labels:
        good, bad = flags.get(doc_id, (False, False))
        flags[doc_id] = (good or quality == 1, bad or toxic == 1)
    parts = {}
    for doc_id, lang, text in docs:
        least = first.get(text or "")
        copy = least is not None and (doc_id is None or least < doc_id)
        known = flags.get(doc_id, (False, False)) if doc_id is not None else (False, False)
        parts.setdefault(lang or "", []).append((failed(text or "") + "E" * copy, *known))
    out = []
    for part, rows in parts.items():
        removed_by = Counter()
        held = []
        for order in permutations("ABCDE"):
            left, gone = rows, []
            for step, name in enumerate(order, 1):
                lost = [r for r in left if name in r[0]]
                removed_by[name] += len(lost)
                redundant = sum(name in r[0] for r in gone)
                left, gone = [r for r in left if name not in r[0]], gone + lost
                held.append((part, "".join(order), step, len(left), len(lost), redundant, sum(r[0] == name for r in rows), sum(r[1] for r in lost), sum(r[2] for r in lost), name))
        out += [(*row[:-1], removed_by[row[-1]]) for row in held]
    return out


def compare(spark, docs, labels, files, batches):
    """``files`` lists of (doc_id, lang, text), written one by one so that a stream meets them in that order."""
    path = scratch(spark, "audit-docs")
    for rows in files:
        spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, lang string, text string, mask string").coalesce(1).write.mode("append").parquet(path)
    known = spark.createDataFrame(labels, LABELS)
    got = rows_of(filter_audit.audit(spark, path, known, scratch(spark, "audit"), batches=batches))
    assert sorted(got) == sorted(brute(docs, labels))
    assert len(got) == 600 * len({lang or "" for _, lang, _ in docs})


def test_smaller_ids_that_come_later(spark):
    """Every micro-batch brings smaller ids of texts met before, in other parts and with other labels."""
    draw = random.Random(5)
    texts = ["few words", " ".join(f"w{i}" for i in range(120)), "same " * 150, "LOUD WORDS " * 60, "a # sign", "", "MANY # " * 80]
    docs = [(i, draw.choice(["en", "de", None, ""]), draw.choice(texts)) for i in range(60)]
    docs += [(7, "en", "few words"), (7, "en", "few words"), (None, "en", "few words"), (None, "fr", "alone"), (None, "fr", "alone"), (3, "es", None)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 60, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (999, 1, 1)]
    late_first = sorted(docs, key=lambda r: -(r[0] if r[0] is not None else 1000))
    files = [late_first[i : i + 17] for i in range(0, len(late_first), 17)]
    compare(spark, docs, labels, files, batches=len(files))


def test_documents_against_brute_force(spark, small_docs):
    labels = rows_of(spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic"))
    docs = rows_of(small_docs.select("doc_id", "lang", "text"))
    compare(spark, docs, labels, [docs[100:], docs[:100]], batches=2)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = rows_of(odd_docs.select("doc_id", "lang", "text"))
    compare(spark, docs, [], [docs], batches=1)
    path = scratch(spark, "audit-docs")
    no_docs.write.parquet(path)
    nothing = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(spark, path, nothing, scratch(spark, "audit")).collect() == []


def test_counters_whatever_the_batches():
    """Any split of a text's rows into batches gives the counters of all rows at once."""
    draw = random.Random(11)
    for _ in range(300):
        rows = [(draw.choice([0, 0, 0, 1]), draw.randint(0, 6), draw.choice("xy"), 3, draw.choice([0, 1]), draw.randint(1, 3)) for _ in range(8)]
        rows = [(rank, 0 if rank else i, *rest) for rank, i, *rest in rows]
        total, state = Counter(), None
        left = list(rows)
        while left:
            take = draw.randint(1, 4)
            deltas, state = filter_audit._deltas(left[:take], state)
            total.update(deltas)
            left = left[take:]
        first, want = min(r[:2] for r in rows), Counter()
        for rank, i, part, mask, label, n in rows:
            want[part, mask | (0 if (rank, i) == first else 16), label] += n
        assert {k: n for k, n in total.items() if n} == dict(want)


def test_words_of_long_texts(monkeypatch):
    raw = " ".join(f"w{i % 37}\t" for i in range(5000)).encode()
    want = filter_audit.word_counts(raw)
    assert want == (5000, 37)
    monkeypatch.setattr(filter_audit, "CHUNK", 100)
    assert filter_audit.word_counts(raw) == want and filter_audit.word_counts(b"x" * 999) == (1, 1)


@pytest.mark.parametrize("salts", [1, 5])
def test_labels_too_large_to_broadcast(spark, monkeypatch, salts):
    monkeypatch.setattr(filter_audit, "broadcast_if_small", lambda df: df)
    rows = spark.range(50).select(F.lit(0).alias("rank"), F.col("id").alias("doc_id"), F.lit("p").alias("part"), F.lit(0).alias("mask"), F.col("id").alias("high"), F.lit(0).cast("long").alias("low"))
    flags = spark.createDataFrame([(i, 1) for i in range(0, 50, 2)], "_labelled long, label int")
    got = {r.doc_id: r.label for r in filter_audit.with_labels(rows, flags, salts).collect()}
    assert got == {i: int(i % 2 == 0) for i in range(50)}


def narrow(df, doc_id, rank=filter_audit.PRESENT):
    values = {"rank": F.lit(rank), "doc_id": doc_id, "part": F.lit("p"), "mask": F.lit(0), "high": F.lit(7).cast("long"), "low": F.lit(0).cast("long")}
    return df.select(*[c.alias(name) for name, c in values.items()])


def test_many_labels_are_not_sent_through_the_driver(spark):
    """Labels whose number follows the table's are shuffled, whatever the planner expects of their files."""
    path = scratch(spark, "audit-labels")
    spark.range(100_000).select(F.col("id").alias("_labelled"), F.lit(1).alias("label")).write.parquet(path)
    joined = filter_audit.with_labels(narrow(spark.range(100_100), F.col("id")), spark.read.parquet(path))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert joined.filter("label = 1").count() == 100_000 and joined.count() == 100_100
    few = filter_audit.with_labels(narrow(spark.range(10), F.col("id")), spark.createDataFrame([(3, 1)], "_labelled long, label int"))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()


def test_hot_ids_and_rows_without_id_are_dealt_out(spark, monkeypatch):
    """One text under one id, and without an id: labels stay right, and no task gets more than its share."""
    monkeypatch.setattr(filter_audit, "broadcast_if_small", lambda df: df)
    hot, none = narrow(spark.range(2000), F.lit(5).cast("long")), narrow(spark.range(2000), F.lit(0).cast("long"), filter_audit.ABSENT)
    rows = hot.unionByName(none).unionByName(narrow(spark.range(100), F.col("id")))
    flags = spark.createDataFrame([(0, 2), (5, 3), (7, 1)], "_labelled long, label int")
    adaptive, partitions = (spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        joined = filter_audit.with_labels(rows, flags, hot=lambda: [5])
        got = {(r["rank"], r["doc_id"], r["label"]): r["count"] for r in joined.groupBy("rank", "doc_id", "label").count().collect()}
        most = max(joined.groupBy(F.spark_partition_id()).count().select("count").collect())[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    want = {(0, i, {0: 2, 7: 1}.get(i, 0)): 1 for i in range(100) if i != 5} | {(0, 5, 3): 2001, (1, 0, 0): 2000}
    assert got == want and most < 1000


def test_ids_that_are_hot(spark):
    docs = spark.range(5000).select(F.when(F.col("id") < 4000, F.col("id")).when(F.col("id") < 4500, 1).when(F.col("id") < 4504, 2).alias("doc_id"))
    assert filter_audit.hot_ids(docs, 5000) == [1]


def test_large_labels_in_the_stream(spark, small_docs, monkeypatch):
    """The shuffled labels give what brute force gives, in micro-batches too."""
    monkeypatch.setattr(filter_audit, "broadcast_if_small", lambda df: df)
    labels = rows_of(spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic"))
    docs = rows_of(small_docs.select("doc_id", "lang", "text")) + [(None, "en", "few words")] * 3 + [(labels[0][0], "en", "few words")] * 5
    compare(spark, docs, labels, [docs[100:], docs[:100]], batches=2)


def test_state_in_as_many_partitions_as_its_rows_need(spark):
    """What tasks tell the driver grows with the square of the partitions, so a session's thousands are not taken up for few rows."""
    assert filter_audit.store_partitions(3_000_000, 6, 610) == 60 and filter_audit.store_partitions(10, 6, 610) == 12
    assert filter_audit.store_partitions(3_000_000, 6, 16) == 16 and filter_audit.store_partitions(10**9, 6, 10**5) == 1000
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    path, root = scratch(spark, "audit-docs"), scratch(spark, "audit")
    spark.createDataFrame([(1, "en", "few words")], "doc_id long, lang string, text string").write.parquet(path)
    spark.conf.set(name, "60")
    try:
        assert filter_audit.audit(spark, path, spark.createDataFrame([(1, 1, 0)], LABELS), root).count() == 600
        assert spark.conf.get(name) == "60"
    finally:
        spark.conf.set(name, before)
    stores = spark.read.format("state-metadata").load(f"{root}/checkpoint").select("numPartitions").collect()
    assert [r[0] for r in stores] == [min(60, 2 * spark.sparkContext.defaultParallelism)]
