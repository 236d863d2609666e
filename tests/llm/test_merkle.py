import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tidelake.llm import merkle
from tidelake.session import scratch


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return H(*map(field, (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes):
    """The root, and of each leaf the siblings level by level with its place among them."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i : i + 8] for i in range(0, len(level), 8)]
        for k, place in enumerate(at):
            run, i = runs[place // 8], place % 8
            proofs[k].append((run[:i], run[i + 1 :]))
            at[k] = place // 8
        level = [H(*run) for run in runs]
    return (level[0] if level else None), proofs


def brute(docs):
    langs = {}
    for row in docs.collect():
        langs.setdefault(row.lang, []).append((leaf(row, row.text), row))
    names = sorted(langs, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in names:
        langs[name].sort(key=lambda x: (x[1].doc_id is not None, x[1].doc_id or 0, x[0]))
        trees[name] = tree([d for d, _ in langs[name]])
    root, above = tree([trees[name][0] for name in names])
    out = []
    for name, over in zip(names, above, strict=True):
        subroot, proofs = trees[name]
        for (own, row), proof in zip(langs[name], proofs, strict=True):
            path = proof + over
            now = own
            if row.text is not None and row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                now = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text))
            for left, right in path:
                now = H(*left, now, *right)
            proof_digest = H(*(x for left, right in path for x in left + right))
            out.append((row.doc_id, own, subroot, root, proof_digest, now, now == root))
    return out


def same(docs):
    got = rows_of(merkle.manifest(docs, scratch(docs.sparkSession, "merkle")))
    want = brute(docs)
    assert sorted(map(str, got)) == sorted(map(str, want))
    return got


def test_documents_against_brute_force(small_docs):
    got = same(small_docs)
    assert {r[6] for r in got} == {True, False}


def test_odd_rows(odd_docs, no_docs):
    assert same(odd_docs.withColumn("lang", F.when(F.col("doc_id") > 3, F.lit("ü")).when(F.col("doc_id") > 1, F.lit(""))))
    assert same(odd_docs.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("en")))
    assert merkle.manifest(no_docs, scratch(no_docs.sparkSession, "merkle")).collect() == []


@pytest.mark.parametrize("size", [1, 9, 600])
def test_sizes_of_trees(spark, size):
    """Trees of 1, 2 and 3 levels with a short last run, and langs of one row."""
    rows = [(i * 5 % size, f"Text {i * 5 % size}", "en", None, 3) for i in range(size)] + [(7000 + k, "One", f"l{k}", "s", k) for k in range(9)]
    same(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(1, "Same", "en", "s", 4)] * 130 + [(i, "Other", "en", "s", 5) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = scratch(spark, "merkle")
    got = rows_of(merkle.manifest(docs, path))
    assert sorted(map(str, got)) == sorted(map(str, brute(docs)))
    records = spark.read.parquet(f"{path}/langs")
    assert records.count() == records.select("digest", "height").distinct().count()
    assert records.filter("height = 1").count() < 19  # runs of equal leaves have one record
    assert records.filter(F.sha2(F.array_join("children", ""), 256) != F.col("digest")).count() == 0


def test_some_requests_only(spark):
    """A descent for a few leaves opens no records but those on their ways."""
    leaves = spark.range(700).select(F.lit("g").alias("_group"), F.col("id").alias("_rank"), F.lit(4).alias("_depth"), F.sha2(F.col("id").cast("string"), 256).alias("_digest"))
    store, tops = merkle.build(leaves, scratch(spark, "merkle"))
    entries = tops.select("*", F.col("_digest").alias("_top"), F.array().cast("array<struct<left:string,right:string>>").alias("_path"))
    wanted = leaves.filter("_rank in (0, 9, 511, 699)").select("_group", "_rank", "_depth")
    got = {r._rank: (r._found, [(s.left, s.right) for s in r._path]) for r in merkle.descend(store, entries, wanted).collect()}
    root, proofs = tree([H(str(i)) for i in range(700)])
    assert tops.first()._digest == root
    assert got == {i: (H(str(i)), [("".join(a), "".join(b)) for a, b in reversed(proofs[i])]) for i in (0, 9, 511, 699)}
