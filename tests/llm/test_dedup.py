import hashlib
import re

import pytest

from tests.llm.conftest import rows_of
from tidelake.llm import exact_dedup, minhash_join
from tidelake.llm.components import components


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups_against_brute_force(small_docs, odd_docs):
    for docs in (small_docs, odd_docs):
        rows = rows_of(docs.select("doc_id", "text"))
        groups = {}
        for doc_id, text in rows:
            groups.setdefault(normal(text), []).append(doc_id)
        got = rows_of(exact_dedup.duplicate_groups(docs))
        want = []
        for doc_id, text in rows:
            ids = [i for i in groups[normal(text)] if i is not None]
            want.append((doc_id, min(ids) if ids else None, len(groups[normal(text)]), hashlib.sha256(normal(text).encode()).hexdigest()))
        assert sorted(map(str, [(a, b, c, e) for a, b, c, _, e in got])) == sorted(map(str, want))
        kept = {}
        for doc_id, keep_id, _, is_kept, digest in got:
            assert not is_kept or doc_id == keep_id
            kept[digest] = kept.get(digest, 0) + is_kept
        assert set(kept.values()) == {1}


def test_exact_rows_kept(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        kept = exact_dedup.deduplicate(docs)
        assert kept.columns == docs.columns
        rows = rows_of(kept.select("doc_id", "text"))
        all_rows = rows_of(docs.select("doc_id", "text"))
        assert len(rows) == len({normal(t) for _, t in all_rows})
        for doc_id, text in rows:
            ids = [i for i, t in all_rows if normal(t) == normal(text) and i is not None]
            assert doc_id == (min(ids) if ids else None)
    assert exact_dedup.deduplicate(no_docs).collect() == [] == exact_dedup.duplicate_groups(no_docs).collect()


def test_equal_digests_of_different_contents_stay_apart(spark):
    keyed = spark.createDataFrame([("d", "x", 1), ("d", "y", 2), ("d", "x", 3)], "_digest string, _content string, doc_id long")
    from pyspark.sql import functions as F

    out = exact_dedup.merge_copies(keyed, {"b": F.min("doc_id")}, {"b": F.min("b")}).select("_content", "b")
    assert sorted(rows_of(out)) == [("x", 1), ("y", 2)]


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((m for m in members[find(i)] if m is not None), default=None)) for i in range(len(rows))]


@pytest.fixture(scope="module")
def near_docs(make_docs):
    """Chains and stars of near copies, a passage shared by different texts, short texts."""
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n * 3 + 1, " ".join(words), "s"))
        n += 1

    base = [f"b{i}" for i in range(120)]
    for k in range(40):  # around one text, two of them often less than 0.8 alike
        copy = list(base)
        copy[k * 3] = f"changed{k}"
        if k % 3 == 0:
            copy[(k * 7 + 50) % 120] = f"other{k}"
        add(copy)
    chain = [f"c{i}" for i in range(100)]
    for k in range(8):  # each like the one before it only
        add(chain)
        chain = [*chain[3:], f"n{k}1", f"n{k}2", f"n{k}3"]
    passage = [f"p{i}" for i in range(60)]
    for k in range(30):  # half of each text is the same passage
        add([*passage, *(f"own{k}_{i}" for i in range(40 + k))])
    add(["Only", "Two"])
    add(["only", "two"])
    add(["only", "three"])
    return make_docs([*rows, (None, " ".join(base), "s"), (5000, None, None), (5001, "", "s"), (1, rows[0][1], "s"), (1, rows[0][1], "s")])


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups_against_brute_force(near_docs, small_docs, odd_docs, size):
    for docs in (near_docs, small_docs, odd_docs.filter("doc_id is null or doc_id not in (4, 5)")):
        rows = rows_of(docs.select("doc_id", "text"))
        got = rows_of(minhash_join.near_groups(docs, size).select("doc_id", "n_shingles", "component_id"))
        assert sorted(map(str, got)) == sorted(map(str, brute_components(rows, size)))


def test_near_rows_kept(near_docs, no_docs):
    kept = minhash_join.deduplicate(near_docs)
    assert kept.columns == near_docs.columns
    groups = minhash_join.near_groups(near_docs).toPandas()
    assert sorted({r.doc_id for r in kept.collect()} - {5000, 5001}) == sorted(groups[groups.n_shingles > 0].component_id.unique())
    assert minhash_join.near_groups(no_docs).collect() == [] == minhash_join.deduplicate(no_docs).collect()


def test_signatures_estimate_similarity():
    one = minhash_join.shingles(" ".join(f"w{i}" for i in range(400)).encode())
    two = minhash_join.shingles(" ".join(f"w{i}" for i in range(40, 440)).encode())
    true = len(set(one.tolist()) & set(two.tolist())) / len(set(one.tolist()) | set(two.tolist()))
    same = (minhash_join.signature(one) == minhash_join.signature(two)).mean()
    assert abs(same - true) < 0.2


def test_components_of_stars_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 200)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 200)}, 300: 300, 301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_random_graphs_against_union_find(spark):
    import random

    for size, links, seed in ((400, 150, 1), (400, 380, 2), (60, 900, 3)):
        draw = random.Random(seed)
        edges = [(draw.randrange(-size, size), draw.randrange(-size, size)) for _ in range(links)]
        root = {n: n for e in edges for n in e}

        def find(n, root=root):
            while root[n] != n:
                n = root[n]
            return n

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        linked = {n for a, b in edges if a != b for n in (a, b)}
        assert sorted(rows_of(components(spark.createDataFrame(edges, "a long, b long")))) == sorted((n, find(n)) for n in linked)


def test_few_links_take_few_tasks_of_many_partitions(spark):
    # A star, a chain and a pair: they took some 2300 tasks a round over 211 partitions, all but a handful of them without rows.
    edges = [(i, 0) for i in range(1, 500)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2001)]
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    context = spark.sparkContext
    try:
        context.setJobGroup("few-links", "components")
        got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long").repartition(211))))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == {**dict.fromkeys(range(500), 0), **dict.fromkeys(range(1000, 1041), 1000), 2000: 2000, 2001: 2000}
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-links") for s in tracker.getJobInfo(j).stageIds}
    assert sum(tracker.getStageInfo(s).numCompletedTasks for s in stages if tracker.getStageInfo(s)) < 2000
