import re

import numpy as np

from tests.llm.conftest import rows_of
from tidelake.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 3000 else None
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, covered and len(covered)


def test_counts_against_brute_force(spark, small_docs, odd_docs):
    for docs in (small_docs, odd_docs.filter("doc_id is null or doc_id not in (4, 5)")):
        texts = rows_of(docs.select("doc_id", "text"))
        got = q.judged(docs, []).select("doc_id", *q.COUNTS[:5], "base_failed", "kept")
        want = []
        for doc_id, text in texts:
            n, chars, symbols, dup, repeat = brute(text)
            if repeat is None and n >= 3000:
                repeat = q.count_text(text.encode())[4]
            repeat = repeat or 0
            failed = n < 50 or 100 * repeat > 50 * n
            want.append((doc_id, n, chars, symbols, dup, repeat, failed, not failed))
        assert sorted(map(str, rows_of(got))) == sorted(map(str, want))


def test_learned_list_separates_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rules = q.fit(docs, train)
    assert rules
    judged = q.judged(docs, rules).filter("not base_failed").join(held, "doc_id").select("quality", "kept").toPandas()
    good, bad = judged[judged.quality == 1], judged[judged.quality == 0]
    assert good.kept.mean() > 0.98
    assert (~bad.kept).mean() > 0.9


def test_covering_finds_a_conjunction():
    rng = np.random.default_rng(5)
    values = rng.random((3000, len(q.FEATURES)))
    bad = (values[:, 0] > 0.7) & (values[:, 3] < 0.4)
    rules = q.learn_rules(values, bad)
    held = np.zeros(3000, bool)
    for rule in rules:
        held |= q._covered(rule, values)
    assert (held == bad).mean() > 0.98


def test_no_labels_no_rules(spark, small_docs, no_docs):
    labels = spark.createDataFrame([(None, 0), (1, None), (2, 1)], "doc_id long, quality int")
    assert q.fit(small_docs, labels) == []
    assert q.fit(no_docs, labels) == []
    assert q.judged(no_docs, []).collect() == []


def test_kept_rows_keep_their_columns(make_docs):
    docs = make_docs([(1, " ".join(f"w{i}" for i in range(60)), "a"), (2, "short", "a"), (None, None, None)])
    kept = q.keep_good(docs, [])
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]


def test_texts_are_counted_once_a_task(spark, small_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality long")
    for out in (q.labelled(small_docs, labels), q.keep_good(small_docs, []), q.judged(small_docs, [])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
