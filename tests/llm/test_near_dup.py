"""Near duplicates against all pairs by brute force."""

import random
import re

import numpy as np
import pytest
from conftest import TESTDATA

from tidemill.llm import near_dup
from tidemill.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, words):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or {tuple(w)}


def brute(docs, words, percent=80):
    sets = [shingle_set(t, words) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x] if j < i}
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)) if s else d, d == (least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1))


def copies(seed, n, edits):
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(90)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(len(w))] = f"x{r.randrange(10 ** 6)}"
        out.append(" ".join(w).replace("w1", r.choice(["w1", "W1"])))
    return out


@pytest.mark.parametrize("words,seed", [(2, 1), (5, 2)])
def test_against_all_pairs(spark, monkeypatch, words, seed):
    """A large group of copies in chains, small groups, equal texts; blocks of a few members."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    texts = copies(seed, 150, 14) + copies(seed + 10, 30, 9) + copies(seed + 20, 4, 3) + [f"only {i} here" for i in range(9)]
    texts += texts[:20] + ["one", "One", "", None, "  ", "a b", "a b a b a b"]
    docs = [((i * 37) % 1009, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, key int").repartition(4)
    got = near_dup.link(df, words).collect()
    assert order(got) == order(brute(docs, words))
    assert len({r.component_id for r in got if r.n_shingles}) < 0.8 * len(docs)


def test_repeated_ids_and_nulls(spark):
    a, b, c = copies(5, 1, 1)[0], copies(6, 1, 1)[0], "some other text of a few words"
    docs = [(1, a), (1, b), (2, a), (3, b), (3, b), (None, c), (None, c), (None, a), (4, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = near_dup.link(df, 5).collect()
    want = [(d, n, c_, d == c_) for d, n, c_, _ in brute(docs, 5)]
    assert order(got) == order(want)
    assert near_dup.link(df.limit(0), 5).collect() == []


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60000))
    df = spark.createDataFrame([(1, long), (2, long + " x"), (3, "w1 w2")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_dup.link(df, 2).collect()) == [(1, 1), (2, 1), (3, 3)]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()]
    assert order(QUERIES["op9_near_dup"](spark, TESTDATA).collect()) == order(brute(docs, 2))


def test_posterior_bounds():
    """A pair at the threshold is dropped at most about as often as the miss probability allows."""
    least = near_dup.least_matches(80)
    p = 0.8 + 0.2 / 256
    rng = np.random.default_rng(3)
    hits = np.cumsum((rng.random((200_000, len(least), near_dup.BATCH)) < p).sum(2), axis=1)
    assert (hits < np.array(least)).any(1).mean() < 1e-3
    hits = np.cumsum((rng.random((20_000, len(least), near_dup.BATCH)) < 0.5).sum(2), axis=1)
    assert (hits < np.array(least)).any(1).mean() > 0.99


def test_marks_that_agree_in_an_earlier_band(spark):
    """Equal marks in a band that a pair does not share do not keep it from meeting in the band that it does share."""
    rng = np.random.default_rng(4)
    marks = rng.integers(0, 256, near_dup.HASHES, np.uint8)
    bands = rng.integers(0, 2 ** 62, (2, near_dup.BANDS), np.uint64) & ~np.uint64(near_dup.BANDS - 1) | np.arange(near_dup.BANDS, dtype=np.uint64)
    shared = [9, 20]
    bands[1, shared] = bands[0, shared]
    some = np.sort(rng.integers(0, 2 ** 62, 50, np.uint64)).tobytes()
    reps = spark.createDataFrame([(k, 50, bytearray(marks.tobytes()), bytearray(bands[k - 1].tobytes())) for k in (1, 2)],
                                 "key long, n long, marks binary, bands binary")
    sets = spark.createDataFrame([(k, bytearray(some)) for k in (1, 2)], "key long, hashes binary")
    for band, want in ((9, [(1, 2)]), (20, [])):
        met = spark.createDataFrame([(int(bands[0, band]), 0, "other", 0, k - 1, k, k) for k in (1, 2)],
                                    "h long, i int, kind string, j int, side int, key long, comp long")
        assert [tuple(r) for r in near_dup.block_links(met, reps, sets, 80).collect()] == want
