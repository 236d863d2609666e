import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import rows_of
from tidelake.llm import mixing, sharding


def water_fill(sizes):
    """Targets of the contract by iteration: the excess over twice a source's size goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_names, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        rate = left / sum(weights[s] for s in open_names) if open_names else 0
        over = {s for s in open_names if rate * weights[s] > 2 * sizes[s] or not sizes[s]}
        if not over:
            return {**target, **{s: rate * weights[s] for s in open_names}}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_names -= over


def test_targets_and_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sources = dict(rows_of(docs.select("doc_id", "source")))
    got = rows_of(mixing.mixed_sizes(docs))
    words = {i: len((t or "").encode().split()) for i, t in rows_of(docs.select("doc_id", "text"))}
    assert {r[0]: r[1] for r in got} == words
    sizes, taken, longest = Counter(), Counter(), Counter()
    for doc_id, size, _, _, n in got:
        assert n in (0, size, 2 * size)
        sizes[sources[doc_id]] += size
        taken[sources[doc_id]] += n
        longest[sources[doc_id]] = max(longest[sources[doc_id]], size)
    want = water_fill(sizes)
    for doc_id, _, source_size, target, _ in got:
        assert source_size == sizes[sources[doc_id]] and target == pytest.approx(want[sources[doc_id]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s]
    assert sorted(got) == sorted(rows_of(mixing.mixed_sizes(docs)))


def test_inclusion_follows_the_odds(spark):
    """Many short and long documents of one source: the rate of a length class is its weight times a common one."""
    rows = [(i, "w " * (4 if i % 2 else 64), s) for i in range(6000) for s in ("a",)] + [(9000 + i, "w " * 300, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mean = defaultdict(list)
    for _, size, source_size, target, taken in rows_of(mixing.mixed_sizes(docs)):
        if size < 300:
            mean[size].append(taken / size)
    rate = {k: sum(v) / len(v) for k, v in mean.items()}
    assert rate[64] / rate[4] == pytest.approx(8 / 4, rel=0.15) or rate[64] == 2


def test_mix_repeats_rows(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        mixed = mixing.mix(docs)
        assert mixed.columns == docs.columns
        taken = defaultdict(int)
        for doc_id, size, _, _, n in rows_of(mixing.mixed_sizes(docs)):
            taken[doc_id] += n
        words = defaultdict(int)
        for doc_id, text in rows_of(mixed.select("doc_id", "text")):
            words[doc_id] += len((text or "").encode().split())
        assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix(no_docs).collect() == [] == mixing.mixed_sizes(no_docs).collect()


def test_odd_rows_of_a_mix(odd_docs):
    got = rows_of(mixing.mixed_sizes(odd_docs))
    assert len(got) == odd_docs.count()
    assert all(n in (0, size, 2 * size) for _, size, _, _, n in got)
    assert len({n for i, size, _, _, n in got if i == 3}) == 1


def test_shards(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        texts = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(docs.select("doc_id", "text")))
        got = rows_of(sharding.shard_documents(docs, [1.0] * 16))
        assert Counter((r[0], r[1], r[2]) for r in got) == texts
        slots, place = defaultdict(list), {}
        for doc_id, _, _, law, shard, slot, grown in got:
            assert law == "key" and grown in (shard, 16) and 0 <= shard < 16
            assert place.setdefault(doc_id, (shard, grown)) == (shard, grown)
            slots[shard].append(slot)
        for numbers in slots.values():
            assert sorted(numbers) == list(range(len(numbers)))
    assert sharding.shard_documents(no_docs, [1.0] * 16).collect() == []


def test_weights_and_growth(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "cast(id as string) AS text")
    heavy = Counter(r.shard for r in sharding.shard_documents(docs, [1.0, 2.0, 5.0]).collect())
    assert heavy[0] == pytest.approx(5000, rel=0.1) and heavy[2] == pytest.approx(25_000, rel=0.05)
    rows = sharding.shard_documents(docs, [1.0] * 16).collect()
    assert sum(r.grown_shard == 16 for r in rows) == pytest.approx(40_000 / 17, rel=0.1)
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, [])


def test_native(spark, small_docs):
    for df in (mixing.mixed_sizes(small_docs), mixing.mix(small_docs), sharding.shard_documents(small_docs, [1.0] * 16)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "NestedLoop"))
