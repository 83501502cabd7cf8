"""Repeated word windows against brute force."""

import hashlib
import random
import re

import pytest
from conftest import TESTDATA

from tidemill.llm import meeting, substring_dedup
from tidemill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window):
    """docs: (id or None, text) rows. Returns (id, n_words, n_removed, kept) rows."""
    rows = [(d, WORD.findall(t or "")) for d, t in docs]
    least = {}
    for d, w in rows:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            key = float("inf") if d is None else d
            least[k] = min(least.get(k, key), key)
    out = []
    for d, w in rows:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (float("inf") if d is None else d):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_covers():
    for v, cover in substring_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert substring_dedup.cover_for(13) == (7, (0, 1, 3), 7)


@pytest.mark.parametrize("window,seed", [(13, 1), (13, 2), (4, 3), (1, 4), (41, 5)])
def test_random_texts(spark, monkeypatch, window, seed):
    r = random.Random(seed)
    words = ["a", "b", "é", "of", "the", "x9"]
    base = [r.choice(words) for _ in range(60)]
    docs = []
    for d in range(40):
        parts = []
        for _ in range(r.randrange(0, 4)):
            i = r.randrange(0, 50)
            parts += base[i:i + r.randrange(1, 45)] + [r.choice(words) for _ in range(r.randrange(0, 9))]
        docs.append((d if d % 9 else None, r.choice([" ", "\n", "  ", "\t "]).join(parts)))
    docs += [(5, docs[7][1]), (5, docs[7][1]), (90, None), (91, ""), (-3, docs[12][1])]
    monkeypatch.setattr(meeting, "PAIRS", 50)
    df = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, key string").repartition(3)
    got = [tuple(x) for x in substring_dedup.dedup(df, window).collect()]
    assert order(got) == order(brute(docs, window))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    want = {d: (n, m, hashlib.sha256(k.encode()).hexdigest()) for d, n, m, k in brute(docs, 13)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op4_substring_dedup"](spark, TESTDATA).collect()}
    assert got == want and any(m for _, m, _ in want.values())


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.dedup(df).collect() == []
    long = " ".join(f"w{i}" for i in range(60000))
    df = spark.createDataFrame([(1, long), (2, "x " + long)], "doc_id long, text string")
    assert [(r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup(df).orderBy("doc_id").collect()] == [
        (60000, 0, long), (60001, 60000, "x")]
