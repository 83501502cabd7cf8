"""Repeated byte strings against brute force, and the run-length index against plain comparison."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import meeting, repeats
from tidemill.llm.queries import QUERIES
from tidemill.llm.rlbwt import SEPARATOR, RunIndex, suffix_array


def brute(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = True
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((len(b), int(gone[:len(b)].sum()), int(runs), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def joined(strings):
    return np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.int64), SEPARATOR) for s in strings])


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=25), min_size=1, max_size=6))
def test_matching_statistics(strings):
    strings = [s.encode() for s in strings] + [strings[0].encode()]
    text = joined(strings)
    ends = np.flatnonzero(text == SEPARATOR)
    have = RunIndex(text).matching_statistics()
    for i in range(len(text)):
        best = 0
        for j in range(len(text)):
            k = 0
            while i != j and text[i + k] == text[j + k] != SEPARATOR:
                k += 1
            best = max(best, k)
        assert have[i] == best
    assert len(RunIndex(text).run_lengths) <= len(text) and RunIndex(text).run_lengths.sum() == len(text) and len(ends) == len(strings)


def test_suffix_array():
    text = joined([b"banana", b"ananas", b"aaaaaaaaaaaaaaaaaaaa"])
    order = suffix_array(text).tolist()
    assert order == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    data = np.frombuffer("".join(random.Random(9).choice("ab c") for _ in range(3000)).encode(), np.uint8)
    offsets = np.array([0, 10, 900, 900, 3000])
    whole = repeats.anchors_of(data, offsets, 40)
    monkeypatch.setattr(repeats, "CHUNK", 64)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors_of(data, offsets, 40)))


def corpus(seed):
    r = random.Random(seed)
    base = "".join(r.choice("abé ") for _ in range(400))
    texts = []
    for _ in range(30):
        t = ""
        for _ in range(r.randrange(0, 4)):
            i = r.randrange(0, 300)
            t += base[i:i + r.randrange(5, 100)] + "".join(r.choice("abé xyz") for _ in range(r.randrange(0, 30)))
        texts.append(t)
    return texts + [texts[3], "", None, "ab" * 90, "a" * 100, "short"]


@pytest.mark.parametrize("seed,window,bound", [(1, 40, 4 << 20), (2, 40, 4 << 20), (3, 24, 0), (4, 40, 0), (5, 7, 300)])
def test_random_texts(spark, monkeypatch, seed, window, bound):
    """Also with tiny folds and with buckets that do not fit a task."""
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bound)
    monkeypatch.setattr(repeats, "STRETCHES", 9)
    monkeypatch.setattr(meeting, "PAIRS", 30)
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, b"k") for i, t in enumerate(texts)], "doc_id long, text string, key binary").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove(df, window).collect()}
    want = brute(texts, window)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] for w in want)


def test_repeated_ids_and_nulls(spark):
    texts = ["x" * 10 + "abcdefghijklmnopqrstuvwxyz0123456789" + str(i) * 5 for i in range(3)]
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[2]), (None, None), (7, "abc"), (7, "abc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove(df, 30).collect())
    assert got == sorted(((d or -1), *w) for (d, _), w in zip(rows, brute([t for _, t in rows], 30)))
    assert repeats.remove(df.limit(0), 30).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()
    want = {r.doc_id: (a, b, c, hashlib.sha256(k).hexdigest()) for r, (a, b, c, k) in zip(docs, brute([r.text for r in docs], 400))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op7_repeats"](spark, TESTDATA).collect()}
    assert got == want and any(w[1] for w in want.values())
