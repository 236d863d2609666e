import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import rows_of
from tests.llm.test_dedup import brute_components, normal
from tests.llm.test_quality import brute
from tests.oracle_check import compare, connect
from tidelake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_twins(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) == []


def test_registered():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_stages_on_what_the_one_before_kept(spark, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [rows_of(docs.select("doc_id", "text"))]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.columns[:5] == columns and (name == "bpe" or out.columns == columns)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        held.append(rows_of(docs.select("doc_id", "text")))
    start, good, exact, near, mixed, coded = held
    assert {i for i, t in start if brute(t)[0] >= 50} >= {i for i, _ in good}
    firsts = {}
    for i, t in sorted(good):
        firsts.setdefault(normal(t), i)
    assert sorted(i for i, _ in exact) == sorted(firsts.values())
    assert sorted(i for i, _ in near) == sorted({c for _, _, c in brute_components(exact, 5)})
    words = sum(len(t.split()) for _, t in near)
    assert sum(len(t.split()) for _, t in mixed) == pytest.approx(1.5 * words, rel=0.1)
    assert sorted(coded) == sorted(mixed)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(rows_of(whole.select("doc_id", "text"))) == sorted(coded)
    assert whole.filter("decoded_sha256 <> sha2(text, 256)").count() == 0


def test_odd_rows_and_no_rows_through_all_stages(spark, odd_docs, no_docs, tmp_path):
    """Nulls in every column, empty, long and repeated texts, and a table without rows."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    long_rows = spark.read.parquet(f"{SF}/documents.parquet").limit(30).select(*columns)
    for name, first in (("odd", odd_docs.select(*columns).unionByName(long_rows)), ("none", no_docs.select(*columns))):
        docs = first
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            out.write.parquet(str(tmp_path / name / str(k)))
            docs = spark.read.parquet(str(tmp_path / name / str(k)))
            assert docs.columns[:5] == columns, stage_name
        assert (docs.count() > 0) == (name == "odd") and docs.filter("decoded_sha256 <> sha2(coalesce(text, ''), 256)").count() == 0


def test_token_columns_replace_their_namesakes(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x"), (2, None, 8, None)], "doc_id long, text string, n_tokens int, extra string")
    out = corpus_pipeline.tokens(spark, docs, SF)
    assert out.columns == ["doc_id", "text", "extra", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].n_tokens, rows[2].n_tokens, rows[2].text, bytes(rows[2].token_ids)) == (2, 0, None, b"")
