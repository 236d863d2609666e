import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tidelake.llm import bpe, simple8b, token_counts, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(3)
    texts = ["", "a", " ", "  a  b", "a \n b", "\0a \0b\0", "日本 😀😀", "it's  don't ", "<|endoftext|> a<|endoftext|>b", "x　 y", "a\x1c b", "\t\ta  "]
    texts += ["".join(draw.choice("ab  \n\t\0é日😀.,'s1　\x1c\xa0▁") for _ in range(draw.randint(1, 60))) for _ in range(150)]
    return texts + ["é" * 200, "a" * 3000, "0123456789" * 150, "".join(draw.choice("etaoin") for _ in range(2500))]


def test_piece_counts_whatever_the_chunks(spark, small_docs, odd_docs, odd_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string")
    for docs in (small_docs, odd_docs, odd):
        want = []
        for doc_id, text in rows_of(docs.select("doc_id", "text")):
            n = len(model.encode(text or ""))
            want.append((doc_id, len((text or "").encode()), n, n > 4096))
        for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (700, 4)):
            got = rows_of(token_counts.count_tokens(docs, PIECES, chunk=chunk, overlap=overlap))
            assert sorted(map(str, got)) == sorted(map(str, want))


def test_chunks_overlap_at_stable_places_or_grow():
    model = token_counts.counter(PIECES)
    text = "one two three four " * 300
    plan = token_counts.plan_chunks(text, model, 500, 2)
    assert len(plan) > 5 and plan[0][0] == 0 and plan[-1][1] == len(text)
    for (_, high, _, right), (low, _, left, _) in zip(plan, plan[1:], strict=False):
        assert high - right == low and left == right and any(model.stable(text, i) for i in range(low + 1, high))
    assert token_counts.plan_chunks("a" * 5000, model, 500, 2) == [(0, 5000, 0, 0)]


def test_empty_tables(no_docs):
    assert token_counts.count_tokens(no_docs, PIECES).collect() == []
    assert bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []
    assert token_files.token_digests(no_docs, JSON).collect() == []


def test_ranks_as_the_library(spark, small_docs, odd_docs, odd_texts):
    model = bpe.bpe(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string")
    for docs in (small_docs, odd_docs, odd):
        want = []
        for doc_id, text in rows_of(docs.select("doc_id", "text")):
            ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
            want.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
        got = rows_of(bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN))
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_long_words_as_the_library():
    model = bpe.bpe(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    draw = random.Random(9)
    words = ["".join(draw.choice(letters) for _ in range(draw.randint(1025, 5000))) for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "aé日", "then") for _ in range(4)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in model.ids(words)] == [library.encode_ordinary(w) for w in words]
    assert model.texts(model.ids(words)) == [w.encode() for w in words]


def test_a_full_word_table_changes_nothing():
    model = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    texts = [f"some words numbered {i} and {i * 7}" for i in range(200)]
    want = model.ids(texts)
    model.cache.most = 5
    assert [model.ids([t])[0] for t in texts] == want


def test_pieces_of_odd_texts():
    """White space of every kind at every place, against whole texts, with tables that overflow."""
    model = bpe.Bpe(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})
    draw = random.Random(12)
    signs = ["a", "B1", "é", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2028", "　", "\u200b", ".", "'s", "\0", "日", "7"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 14))) for _ in range(4000)]
    want = [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    for most in (500_000, 50):
        model.cache.most = most
        assert [c for at in range(0, 4000, 500) for c in model.ids(texts[at : at + 500])] == want


def test_files_as_the_library(spark, small_docs, odd_docs, odd_texts, tmp_path):
    library = Tokenizer.from_file(JSON)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts)], "doc_id long, text string")
    for k, docs in enumerate((small_docs, odd)):
        want, start = [], 0
        for doc_id, text in sorted(rows_of(docs.select("doc_id", "text"))):
            ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        path = str(tmp_path / f"ids-{k}")
        token_files.write_ids(docs, JSON, path, row_ids=500)
        assert sorted(rows_of(token_files.read_ids(spark, path))) == want
    got = rows_of(token_files.token_digests(odd_docs, JSON))
    assert len(got) == odd_docs.count()
    ends = sorted((start, start + n) for _, start, n, _ in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    by_start = [doc_id for doc_id, *_ in sorted(got, key=lambda r: r[1])]
    assert by_start == sorted(by_start, key=lambda i: (i is not None, i or 0))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1), st.just(0)), max_size=1500), st.integers(1, 700))
def test_simple8b_round_trip(values, block):
    ids = np.array(values, np.uint64)
    coded = simple8b.encode(ids, block)
    assert (simple8b.decode(coded) == ids).all() and len(simple8b.decode(coded)) == len(ids)
    assert (simple8b.decode(coded, 1, 3) == ids[block : 3 * block]).all()


def test_simple8b_packs():
    assert len(simple8b.encode(np.zeros(51_200, np.uint64))) < 51_200 / 8
    assert len(simple8b.encode(np.full(51_200, 1000, np.uint64))) < 51_200 * 1.5
    with pytest.raises(ValueError):
        simple8b.decode(b"x" * 40)


def test_token_stage_holds_little_beside_whole_rows(monkeypatch):
    seen = {"words": 0, "tokens": 0}
    recurse, decode = bpe.Bpe._recurse, bpe.Bpe._decode

    def recursed(self, words):
        seen["words"] = max(seen["words"], sum(map(len, words)))
        return recurse(self, words)

    def decoded(self, coded):
        seen["tokens"] = max(seen["tokens"], sum(len(c) // 4 for c in coded))
        return decode(self, coded)

    texts = [" ".join(f"w{hashlib.sha256(f'{i} {j}'.encode()).hexdigest()[:12]}" for j in range(500)) for i in range(150)]
    want = bpe.Bpe(RANKS, public_tokenizers.PATTERN).ids(texts)
    monkeypatch.setattr(bpe.Bpe, "_recurse", recursed)
    monkeypatch.setattr(bpe.Bpe, "_decode", decoded)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    out = pa.Table.from_batches(list(bpe._add(RANKS, public_tokenizers.PATTERN, "text")([batch])))
    assert out["token_ids"].to_pylist() == want
    assert out["decoded_sha256"].to_pylist() == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert 0 < seen["words"] <= 100_000 and 0 < seen["tokens"] <= 150_000
