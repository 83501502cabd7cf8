"""Byte-level BPE against the public library, and round trips."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import bpe, token_counts
from tidemill.llm.queries import QUERIES, tokenizer

ODD = ["", " ", "a", "\n\n  \n", "it's we'll I'd", "x" * 300, "ab" * 700, "é" * 400, "\x1c\x1d \x85 a", "１２３ 4٣", " 　 b", "😀👨‍👩‍👧 ok",
       "THERHAOU!! $$$ ### %%%", "​﻿", " " * 500 + "x", "İſK", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(tokenizer()[0])


def ids_of(vocab, texts):
    ids, counts = bpe.encode_texts(vocab, P.PATTERN, texts)
    out, at = [], 0
    for n in counts.tolist():
        out.append(ids[at:at + n].tolist())
        at += n
    return out


def test_odd_texts(library, vocab):
    assert ids_of(vocab, ODD) == [library.encode_ordinary(t) for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_any_text(library, vocab, texts):
    assert ids_of(vocab, texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="etaonrish", min_size=200, max_size=900))
def test_long_pieces(library, vocab, text):
    assert ids_of(vocab, [text]) == [library.encode_ordinary(text)]


def test_cache_limit_changes_nothing(library, vocab, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(bpe, "CHUNK_PIECES", 4)
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 20)
    texts = ["one two three four five six", "six five four", "", "seven eight nine ten eleven twelve thirteen"]
    vocab.reset()
    assert ids_of(vocab, texts) == [library.encode_ordinary(t) for t in texts]


def test_query(spark, library):
    from conftest import TESTDATA
    got = {r.doc_id: r for r in QUERIES["op2_bpe_round_trip"](spark, TESTDATA).collect()}
    for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_edge_rows(spark):
    ranks, pattern = tokenizer()
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "ab", "x"), (2, "ab", "x"), (2, "ab", "x")], "doc_id long, text string, ids string")
    rows = bpe.digests(bpe.decode(bpe.encode(docs, ranks, pattern), ranks)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 1), (1, 0), (1, 0), (2, 1), (2, 1)]
    assert bpe.encode(docs.limit(0), ranks, pattern).collect() == []
    assert token_counts.limits(token_counts.histogram(bpe.lengths(docs.limit(0), ranks, pattern))).collect() == []


def test_limits(spark):
    sizes = [0, 0, 3, 3, 5, 2000, 2000, 5000, None]
    lengths = spark.createDataFrame([(n,) for n in sizes if n is not None], "n_tokens long")
    table = token_counts.limits(token_counts.histogram(lengths)).orderBy("length")
    have = [n for n in sizes if n is not None]
    for r in table.collect():
        assert r.n_docs == have.count(r.length)
        assert r.docs_up_to == sum(n <= r.length for n in have) and r.docs_over == sum(n > r.length for n in have)
        assert r.tokens_up_to == sum(n for n in have if n <= r.length) and r.tokens_over == sum(n for n in have if n > r.length)
        assert r.truncated_total == sum(min(n, r.length) for n in have)
        assert r.quantile == pytest.approx(sum(n <= r.length for n in have) / len(have))
    asked = {r.context_limit: r for r in token_counts.answers(table, [0, 4, 2500, 9000]).collect()}
    for limit, r in asked.items():
        assert (r.docs_up_to, r.docs_over) == (sum(n <= limit for n in have), sum(n > limit for n in have))
        assert r.truncated_total == sum(min(n, limit) for n in have)
    assert token_counts.quantile(table, 0.5).first().length == 3


def test_counts_query(spark, library):
    from conftest import TESTDATA
    have = [len(library.encode_ordinary(r.text)) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    rows = QUERIES["op5_token_counts"](spark, TESTDATA).collect()
    assert sum(r.n_docs for r in rows) == len(have)
    assert {(r.length, r.truncated_total) for r in rows} == {(n, sum(min(n, m) for m in have)) for n in set(have)}
