"""Rule measures against plain counting, the model against a plain likelihood search, verdicts against labels."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import weak_rules
from tidemill.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
BIGGER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) by the definition."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n)


def some_text(rng):
    words = ["a", "b", "é", "😀x", "the", "***", "x|", "<p>", "A.", "10"][:rng.randrange(1, 11)]
    return "".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\t", "\r\n", " \n", " ", "\x1c "]) for _ in range(rng.randrange(60)))


EDGES = [None, "", " ", "\n", "\n\n", "a", "a\n", "\na", "a\na\n", "a \na", "same line\nsame line\r\nsame line", "x" * 400_000, "w " * 100_000,
         "a b c d e a b c d e", "a b c d e\n" * 3, "　 a", "*" * 20, "# # # #", "no newline at end\nno newline at end"]


def test_measures_are_plain_counts(spark):
    rng = random.Random(3)
    texts = EDGES + [some_text(rng) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "n_words", "votes", "quality", "kept", "TEXT_")})
    got = weak_rules.report(weak_rules.judged(docs)).collect()
    have = sorted([(str(r.doc_id), *r[1:7]) for r in got])
    assert have == sorted([(str(i), *plain(t)) for i, t in rows])
    assert all(0 <= r.quality <= 1 and r.kept == (not r.base_failed and r.quality >= 0.5) for r in got)


def test_empty_table(spark):
    assert weak_rules.report(weak_rules.judged(spark.createDataFrame([], SCHEMA))).collect() == []


def objective(patterns, counts, share, on_good, on_bad):
    """What the estimate is to make largest: the log likelihood plus the prior's pull, row by row."""
    lean, out = weak_rules.LEAN * sum(counts), 0.0
    for pattern, n in zip(patterns, counts):
        good, bad = share, 1 - share
        for vote, g, b in zip(pattern, on_good, on_bad):
            good *= 1 if vote == 0 else g if vote == -1 else 1 - g
            bad *= 1 if vote == 0 else b if vote == -1 else 1 - b
        out += n * math.log(good + bad)
    pull = lambda p, prior: lean * (prior * math.log(p) + (1 - prior) * math.log(1 - p))
    return out + pull(share, weak_rules.PRIOR_SHARE) + sum(pull(g, weak_rules.PRIOR_ON_GOOD) + pull(b, weak_rules.PRIOR_ON_BAD)
                                                           for g, b in zip(on_good, on_bad))


def test_estimate_is_a_peak_and_finds_planted_rates():
    rng = np.random.default_rng(11)
    n, good_rate, bad_rate = 40_000, np.array([0.02, 0.05, 0.01, 0.1]), np.array([0.7, 0.5, 0.4, 0.6])
    good = rng.random(n) < 0.8
    votes = np.where(rng.random((n, 4)) < np.where(good[:, None], good_rate, bad_rate), -1, 1)
    votes[rng.random((n, 4)) < 0.2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak_rules.estimate(patterns, counts.astype(float), 2000)
    # the prior pulls: a fiftieth of the texts vote with it
    assert abs(model.share - 0.8) < 0.05 and np.abs(model.on_good - good_rate).max() < 0.03 and np.abs(model.on_bad - bad_rate).max() < 0.12
    best = objective(patterns, counts, model.share, model.on_good, model.on_bad)
    for k in range(9):
        for step in (0.999, 1.001):
            values = np.concatenate([[model.share], model.on_good, model.on_bad])
            values[k] *= step
            assert objective(patterns, counts, values[0], values[1:5], values[5:]) <= best + 1e-6
    scaled = weak_rules.estimate(patterns, counts * 1000.0, 2000)
    assert abs(scaled.share - model.share) < 1e-9 and np.allclose(scaled.on_bad, model.on_bad)


def test_quality_is_the_posterior(spark):
    model = weak_rules.Model(0.9, np.array([0.01, 0.2]), np.array([0.5, 0.6]))
    rows = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    got = spark.createDataFrame([([a, b],) for a, b in rows], "votes array<int>").select("votes", model.quality(F.col("votes")).alias("q")).collect()
    for r in got:
        good, bad = 0.9, 0.1
        for vote, g, b in zip(r.votes, model.on_good, model.on_bad):
            good, bad = (good, bad) if vote == 0 else (good * g, bad * b) if vote == -1 else (good * (1 - g), bad * (1 - b))
        assert r.q == pytest.approx(good / (good + bad), rel=1e-12)


def test_copies_do_not_change_the_model(spark):
    rng = random.Random(9)
    texts = [some_text(rng) for _ in range(200)]
    once = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    many = once.unionByName(spark.createDataFrame([(1000 + i, texts[7]) for i in range(300)], SCHEMA))
    a, b = [weak_rules.fit(weak_rules.votes(weak_rules.measures(d))) for d in (once, many)]
    assert a.share == b.share and np.array_equal(a.on_bad, b.on_bad)


def test_query_and_labels(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{BIGGER}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_quality_rules"](spark, BIGGER).collect()}
    assert set(got) == set(docs)
    for d, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(docs[d])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIGGER}/labels.parquet").collect()}  # never seen by the model
    judged = [(got[d].kept, q) for d, q in labels.items() if not got[d].base_failed]
    assert sum(k for k, q in judged if q == 0) == 0
    assert sum(k for k, q in judged if q == 1) >= 0.99 * sum(q for _, q in judged)
