import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text, source) rows, with further columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        extra = {c: docs["n_chars"] for c in ("_row", "n", "keys", "digest", "node", "size", "slot", "_size", "_content", "uid", "kept")}
        return docs.withColumns(extra)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows, repeated ids."""
    long_text = " ".join(f"word{i % 977} the of" for i in range(30_000))
    return make_docs([
        (None, None, None), (None, "", ""), (1, "", "a"), (1, None, "a"), (2, " \n\t ", "a"), (3, "one", None),
        (3, "one", None), (3, "one", None), (4, long_text, "b"), (5, long_text + " end", "b"), (6, "x" * 20_000, "b"), (None, "null id text here", "c"),
        (7, "tab\tand  spaces\n", "c"), (8, "tab and spaces ", "c"), (9, "nul \0 x\0 日本 😀 　 y", "a"),
    ])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df):
    return [tuple(r) for r in df.collect()]
