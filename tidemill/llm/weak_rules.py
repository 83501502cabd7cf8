"""Quality rules under weak supervision: rules vote, and a model of their accuracies decides.

Every rule looks at one measure of a text and votes good, votes bad, or abstains where the measure says nothing. No labels are
used. What a vote is worth is estimated from how rules agree: each document is good or bad (unseen), and each rule votes bad with
a rate of its own among the good and among the bad. Expectation-maximisation finds these rates and the share of good documents;
the probability of being good, given a document's votes, then takes the place of passing all rules at once.

Documents with the same votes are alike to the model, so it is fitted on the number of texts by vote pattern. Patterns are
at most three to the power of the number of rules, whatever the table; only these counts reach the driver. Copies of a text count once, so that a
large group of copies cannot decide what rules are worth. The rates lean on a stated prior (rules mostly pass good texts) with a weight that
is a share of the texts, so that the model behaves alike at every size.

Null and empty texts have no words: all rules abstain, and the probability is the share of good documents. Repeated rows get equal results.
Ids are not read but for the result. A table without rows gives none. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import slices, stored, text_bytes, whole_text
from tidemill.llm.words import mix, prefix_hash, row_of, split_words, starts_inside, stretch_hash, window_hashes, word_hashes

WINDOW = 5           # words of a repeated window
LEAST_WORDS = 10     # a text of fewer words fails
MOST_REPEATED = 20   # percent of words in repeated windows beyond which a text fails
KEEP = 0.5           # least probability of being good
ROUNDS = 200         # of expectation-maximisation, at most
LEAN = 0.02          # weight of the prior, as a share of the texts
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_digits",
            "n_stutter", "n_marked", "n_ended", "text_hash")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER = _table(SYMBOLS), _table(bytes(range(65, 91)))
_LOWER, _DIGIT, _STOP = _table(bytes(range(97, 123))), _table(bytes(range(48, 58))), _table(b".?!")
_PLAIN = _UPPER | _LOWER | _DIGIT | (np.arange(256) >= 128)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each row of a byte array, one text a row."""
    n = len(offsets) - 1

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    starts, ends, first = split_words(data, offsets)
    words, of = np.diff(first), row_of(first)
    per_row = lambda flags: np.bincount(of[flags], minlength=n)
    hashes = word_hashes(data, starts, ends)
    salt = mix(np.arange(n, dtype=np.uint64))
    sums = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = np.bincount(of, weights=sums[ends] - sums[starts], minlength=n).astype(np.int64) if len(of) else np.zeros(n, np.int64)

    # Lines: every row has one more than it has line ends. Those with a word count, and are compared within their row.
    at = np.flatnonzero(data == 10)
    rows = np.concatenate([np.arange(n), np.searchsorted(offsets, at, "right") - 1])
    begins, stops = np.concatenate([offsets[:-1], at + 1]), np.concatenate([at, offsets[1:]])
    begins, stops = begins[np.lexsort((begins, rows))], stops[np.lexsort((stops, np.concatenate([rows[n:], rows[:n]])))]
    rows = np.sort(rows)
    worded = np.searchsorted(starts, stops) > np.searchsorted(starts, begins)
    begins, stops, rows = begins[worded], stops[worded], rows[worded]
    whole = prefix_hash(data)
    lines = mix(stretch_hash(whole, begins, stops) ^ salt[rows]) if len(rows) else np.zeros(0, np.uint64)
    fresh = np.zeros(len(lines), bool)
    fresh[np.unique(lines, return_index=True)[1]] = True

    # Words covered by a window that the row holds twice or more.
    inside = starts_inside(first, WINDOW)
    covered = np.zeros(len(starts) + WINDOW + 1, np.int64)
    if len(inside):
        keys = mix(window_hashes(hashes, WINDOW)[inside] ^ salt[of[inside]])
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = inside[times[which] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    repeated = np.cumsum(covered)[:len(starts)] > 0

    stutter = np.zeros(len(of), bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    before = data[np.maximum(ends - 2, 0)] if len(ends) else last
    alone = (ends - starts) == 1
    marked = ~_PLAIN[last] & (alone | ~_PLAIN[before])
    ended = _STOP[last] & ~marked
    size = np.diff(offsets)
    text_hash = stretch_hash(whole, offsets[:-1], offsets[1:], 7) if len(data) else np.zeros(n, np.uint64)
    return {"n_words": words, "word_chars": chars, "n_symbols": within(_SYMBOL[data]), "n_lines": np.bincount(rows, minlength=n),
            "n_dup_lines": np.bincount(rows[~fresh], minlength=n), "n_repeat_words": per_row(repeated), "n_upper": within(_UPPER[data]),
            "n_lower": within(_LOWER[data]), "n_digits": within(_DIGIT[data]), "n_stutter": per_row(stutter),
            "n_marked": per_row(marked), "n_ended": per_row(ended), "text_hash": np.where(size > 0, text_hash, 0).view(np.int64)}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measures ..) of every whole text."""
    cut = whole_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = measure(*text_bytes(batch.column(1)))
            yield pa.record_batch([batch.column(0), *[pa.array(found[m].astype(np.int64)) for m in MEASURES]], names=["id", *MEASURES])

    return cut.mapInArrow(run, "id long, " + ", ".join(f"{m} long" for m in MEASURES))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` does, else (or if both are null) abstains."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


# Shares are written as products, which are null-free and exact. With no words no rule speaks, and a single repetition or mark is no pattern.
RULES = (
    Rule("length", "n_words >= 20", "n_words BETWEEN 1 AND 4"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words AND n_words > 0",
         "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    Rule("symbols", "n_words > 0 AND 50 * n_symbols <= n_words", "10 * n_symbols >= n_words AND n_symbols > 1"),
    Rule("lines", "n_lines > 1 AND 20 * n_dup_lines <= n_lines", "n_dup_lines > 1 AND 10 * n_dup_lines >= 3 * n_lines"),
    Rule("windows", "n_words >= 10 AND 20 * n_repeat_words <= n_words", "5 * n_repeat_words >= n_words AND n_words > 0"),
    Rule("capitals", "n_upper + n_lower >= 20 AND 5 * n_upper <= n_upper + n_lower", "n_upper + n_lower >= 20 AND 3 * n_upper >= n_upper + n_lower"),
    Rule("stutter", "n_words >= 10 AND 20 * n_stutter <= n_words", "10 * n_stutter >= n_words AND n_stutter > 1"),
    Rule("marks", "n_words > 0 AND 50 * n_marked <= n_words", "10 * n_marked >= n_words AND n_marked > 1"),
    Rule("sentences", "n_words >= 20 AND 50 * n_ended >= n_words AND 2 * n_ended <= n_words", "n_words >= 50 AND 200 * n_ended < n_words"),
    Rule("digits", "word_chars > 0 AND 10 * n_digits <= word_chars", "word_chars > 0 AND 5 * n_digits >= 2 * word_chars"),
)


def votes(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds ``votes``: one of -1, 0, 1 per rule."""
    return measured.withColumn("votes", F.array(*[r.vote().cast("int") for r in rules]))


@dataclass(frozen=True)
class Model:
    """``share`` of good texts; per rule the rate of bad among its votes on good texts and on bad ones."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def log_odds(self) -> tuple[float, list[tuple[float, float]]]:
        """Log odds of good before any vote, and what a bad and a good vote of each rule add."""
        pairs = [(math.log(g / b), math.log((1 - g) / (1 - b))) for g, b in zip(self.on_good, self.on_bad)]
        return math.log(self.share / (1 - self.share)), pairs

    def quality(self, votes: Column) -> Column:
        """The probability that a text with these votes is good."""
        start, pairs = self.log_odds()
        odds = F.lit(start)
        for i, (bad, good) in enumerate(pairs):
            vote = F.get(votes, F.lit(i))
            odds = odds + F.when(vote == -1, F.lit(bad)).when(vote == 1, F.lit(good)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


# The prior: nine of ten texts are good; a rule seldom votes bad on a good text, and on every third bad one.
PRIOR_SHARE, PRIOR_ON_GOOD, PRIOR_ON_BAD = 0.9, 0.01, 0.35


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over vote patterns (rows) and how many texts have each."""
    n_rules = patterns.shape[1]
    share, on_good, on_bad = PRIOR_SHARE, np.full(n_rules, PRIOR_ON_GOOD), np.full(n_rules, PRIOR_ON_BAD)
    total = float(counts.sum())
    if not total:
        return Model(share, on_good, on_bad)
    lean, bad, spoke = LEAN * total, patterns == -1, patterns != 0
    good_votes = patterns == 1
    was = None
    for _ in range(rounds):
        odds = math.log(share / (1 - share)) + bad @ np.log(on_good / on_bad) + good_votes @ np.log((1 - on_good) / (1 - on_bad))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        for_good, for_bad = counts * good, counts * (1 - good)
        share = (for_good.sum() + PRIOR_SHARE * lean) / (total + lean)
        on_good = (for_good @ bad + PRIOR_ON_GOOD * lean) / (for_good @ spoke + lean)
        on_bad = (for_bad @ bad + PRIOR_ON_BAD * lean) / (for_bad @ spoke + lean)
        if was is not None and np.abs(good - was).max() < 1e-9:
            break
        was = good
    return Model(float(share), on_good, on_bad)


def pattern_counts(voted: DataFrame) -> DataFrame:
    """(votes, n): how many different texts have each vote pattern; at most 3 ** rules rows."""
    return voted.groupBy("text_hash", "votes").agg(F.lit(1).alias("one")).groupBy("votes").agg(F.count("*").alias("n"))


def fit(voted: DataFrame) -> Model:
    found = sorted((tuple(r.votes), r.n) for r in pattern_counts(voted).collect())
    width = len(found[0][0]) if found else len(RULES)
    return estimate(np.array([v for v, _ in found], np.int64).reshape(len(found), width), np.array([n for _, n in found], float))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measures .., votes, quality, base_failed, kept) of every document."""
    voted = stored(votes(measures(docs, id_col, text_col)), "rule-votes")
    model = fit(voted)
    failed = base_failed()
    quality = model.quality(F.col("votes"))
    return voted.withColumnRenamed("id", "doc_id").withColumns({"quality": quality, "base_failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))


def report(judged_: DataFrame) -> DataFrame:
    return judged_.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
