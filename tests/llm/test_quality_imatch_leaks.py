"""Quality scores on held-out labels, fingerprints by their rules, benchmark leaks by brute force."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import TESTDATA

from tidemill.llm import decontaminate, imatch, quality
from tidemill.llm.queries import QUERIES

BIGGER = "/root/testdata/sf0.01"


def test_quality_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op6_quality"](spark, BIGGER).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIGGER}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{BIGGER}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [d for d in labels if rows[d].held_out]
    assert len(held) > 50 and np.mean([rows[d].predicted == labels[d] for d in held]) >= 0.97


def test_quality_learns_outside_the_fold_only(spark):
    """Labels of the held-out fold change nothing."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    measured = quality.statistics(docs)
    from pyspark.sql import functions as F
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(measured, labels), quality.fit(measured, other)
    assert np.allclose(a.means, b.means) and np.allclose(a.factors, b.factors) and a.log_odds == b.log_odds


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, "l"), (None, "", "l"), (2, "word " * 50000, "l"), (2, "a b", "m")], "doc_id long, text string, label string")
    measured = quality.statistics(docs)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.scored(measured, quality.fit(measured, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0), (2, 7)], "doc_id long, quality int")
    assert {r.score for r in quality.scored(measured, quality.fit(measured, ones)).collect()} <= {0.5, 1.0}
    model = quality.Model(np.zeros((2, quality.N_STATISTICS)), np.array([np.eye(quality.N_STATISTICS)] * 2), np.zeros(2), 0.0)
    rows = quality.scored(measured, model).collect()
    assert len(rows) == 4 and all(r.score == 0.5 for r in rows) and [r.held_out for r in rows if r.doc_id is None] == [True]
    assert quality.scored(quality.statistics(docs.limit(0)), model).collect() == []


def test_statistics_do_not_depend_on_the_batch():
    texts = ["Ha Ha Ha", "", "One two, three!!\nfour", "é" * 9, " x "]
    together = quality._measured(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality._measured(pa.array([t]))[0])


def edited(texts):
    ids = sorted(texts, reverse=True)
    out = {}
    for i, d in enumerate(ids):
        t, n = texts[d], texts[ids[(i + 1) % len(ids)]]
        k = len(t) // 3
        out[d] = (t[:len(t) - k] + n[:k], ids[(i + 1) % len(ids)])
    return out


def test_imatch_query(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in QUERIES["op10_imatch"](spark, TESTDATA).collect()}
    want = edited(texts)
    assert rows.keys() == texts.keys()
    by_text = {}
    for d, r in rows.items():
        assert r.n_chars == len(texts[d])
        assert r.edited_sha256 == hashlib.sha256(want[d][0].encode()).hexdigest()
        assert by_text.setdefault(texts[d], r.fingerprint) == r.fingerprint
        following = rows[want[d][1]].fingerprint
        a, b = np.frombuffer(r.fingerprint.encode(), "S8"), np.frombuffer(following.encode(), "S8")
        some = ((a != b"0" * 8) | (b != b"0" * 8)).sum()
        same = ((a == b) & (a != b"0" * 8)).sum()
        assert r.near_next == pytest.approx(1.0 if r.fingerprint == following else same / max(some, 1))
    assert np.mean([r.near_edited for r in rows.values()]) > 10 * np.mean([r.near_next for r in rows.values()])


def test_frequencies(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "B c"), (3, None), (4, "a\tb\n")], "doc_id long, text string")
    assert sorted(r.df for r in imatch.frequencies(docs).collect()) == [1, 2, 3]


def test_imatch_edges(spark):
    long = "lorem ipsum " * 30000
    docs = spark.createDataFrame([(5, "a b c d e f g h i", "x"), (7, None, "x"), (None, "q w e r t y u", "x"), (7, long, "x"), (7, long, "x")],
                                 "doc_id long, text string, key string")
    rows = imatch.compare(docs).collect()
    assert len(rows) == 5
    first = next(r for r in rows if r.doc_id == 5)  # the next one is the row without an id
    assert first.edited_sha256 == hashlib.sha256(("a b c d e f g h i"[:12] + "q w e r t y u"[:5]).encode()).hexdigest()
    last = next(r for r in rows if r.doc_id is None)  # after the smallest: the largest id, whose smallest text is empty
    assert last.edited_sha256 == hashlib.sha256("q w e r t y u"[:9].encode()).hexdigest()
    assert imatch.compare(docs.limit(0)).collect() == []
    one = imatch.compare(docs.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_texts_without_lexicon_terms(spark):
    """Unrelated texts outside the lexicon are not the same document; texts of the same terms and empty texts are."""
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta"), (3, "Beta alpha beta"), (4, ""), (5, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in imatch.compare(docs).collect()}
    assert rows[1].fingerprint == rows[3].fingerprint != rows[2].fingerprint
    assert [rows[d].near_next for d in (1, 2, 3, 4, 5)] == [0.0, 0.0, 0.0, 0.0, 1.0]


def test_copies_keep_their_terms(spark):
    """Exact copies that hold a third of the rows take no term out of the lexicon."""
    common = " ".join(f"t{i}" for i in range(30))
    rows = [(i, f"u{i} u{i + 1} own{i}") for i in range(60)] + [(100, common), (101, common + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    copies = spark.createDataFrame([(1000 + i, common) for i in range(40)], "doc_id long, text string")
    alone = imatch.lexicon(docs)
    assert len(alone) >= 30
    assert np.array_equal(imatch.lexicon(docs.union(copies)), alone)


def test_next_over_many_blocks(spark, monkeypatch):
    """Clustered and far-off ids, several to a block, repeated ones too; every block hands over to the next."""
    monkeypatch.setattr(imatch, "LEAST_ROWS", 3)
    ids = [-2 ** 60, -50, -7, -6, 0, 3, 4, 5, 900, 901, 10 ** 12, 10 ** 12 + 1, 2 ** 60]
    docs = spark.createDataFrame([(i, f"text of {i}") for i in ids + [4]], "doc_id long, text string").repartition(5)
    rows = imatch.with_next(docs).collect()
    assert len(rows) == len(ids) + 1
    assert {r.id: r.next_key for r in rows} == {k: ids[i - 1] for i, k in enumerate(ids)}
    want = edited({i: f"text of {i}" for i in ids})
    assert all(r.edited == want[r.id][0] for r in rows)


def test_leaks_query(spark):
    docs = {r.doc_id: r.text.lower().split() for r in spark.read.parquet(f"{BIGGER}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower().split() for r in spark.read.parquet(f"{BIGGER}/benchmark.parquet").collect()}
    index = {}
    for i, w in items.items():
        for k in range(max(1, len(w) - 12)):
            index.setdefault(tuple(w[k:k + 13]), set()).add(i)
    want = set()
    for d, w in docs.items():
        for k in range(max(0, len(w) - 12)):
            want |= {(d, i) for i in index.get(tuple(w[k:k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontaminate"](spark, BIGGER).collect()}
    assert want and want <= got
    assert len(got - want) <= 0.02 * len(got) + 1


QUESTION = "A farmer named Alice sells 12 apples and 30 pears at 4 dollars each; how much money does Alice earn in 12 days of work?"


def test_reparameterised_questions(spark):
    item = spark.createDataFrame([(1, QUESTION, 0), (2, "Too short here.", 0), (3, "Only these six plain words matter.", 0), (4, None, 0),
                                  (5, "take 12 red and 12 blue balls out of the box now", 0)],
                                 "item_id long, text string, hash int")
    other = QUESTION.replace("Alice", "Robert").replace("12", "17").replace("30", "41").replace(" 4 ", " 9 ")
    texts = {
        10: "some words before. " + QUESTION, 11: f"We read that {other} And so on.", 12: other.replace("does Robert", "does Peter").replace("17 days", "99 days"),
        13: "nothing of that kind", 14: None, 15: "", 16: "It says only these six plain words matter. Yes", 17: "too short here", 18: "filler " * 30000 + QUESTION,
        19: "Please take 7 red and 7 blue balls out of the box now.", 20: "Please take 7 red and 8 blue balls out of the box now."}
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts.items()] + [(None, QUESTION, "x"), (10, QUESTION, "x")], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, item).collect()}
    assert set(got) == {(10, 1), (11, 1), (12, 1), (16, 3), (18, 1), (19, 5), (None, 1)}  # 20: one value of the item for two
    assert got[(10, 1)].exact and got[(10, 1)].share == 1.0 and not got[(11, 1)].exact and got[(11, 1)].share == 1.0
    assert decontaminate.leaks(docs.limit(0), item).collect() == []
    assert decontaminate.leaks(docs, item.limit(0)).collect() == []


def test_second_reading(spark):
    """Glued units, runs of number words and names, inner capitals, apostrophes, and scripts without spaces."""
    pairs = [
        ("we put a sack of 5kg onto the old cart before noon", "we put a sack of 12 kg onto the old cart before noon"),
        ("the small train goes at 10km/h along the river to town", "the small train goes at 45km/h along the river to town"),
        ("there were twenty five birds sitting on the long wire outside", "there were 12 birds sitting on the long wire outside"),
        ("yesterday the shop clerk told Mary Jane to come back for change", "yesterday the shop clerk told Bob to come back for change"),
        ("on monday old farmer McDonald had to sell many of his cows", "on monday old farmer Smith had to sell many of his cows"),
        ("every night captain O'Brien will count all of the ropes again", "every night captain Jones will count all of the ropes again"),
        ("小明有12个苹果和一些梨放在桌子上", "小明有30个苹果和一些梨放在桌子上")]
    items = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"so it says: {b}") for i, (_, b) in enumerate(pairs)] + [
        (100 + i, f"so it says: {a}") for i, (a, _) in enumerate(pairs)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, items).collect()}
    assert set(got) == {(i, i) for i in range(7)} | {(100 + i, i) for i in range(7)}
    assert all(r.share == 1.0 and r.exact == (d >= 100) for (d, _), r in got.items())


def test_consistency(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([
        (["<number>1", "<number>1"], ["<number>2", "<number>2"], True), (["<number>1", "<number>1"], ["<number>2", "<number>3"], False),
        (["<number>1", "<number>2"], ["<number>5", "<number>5"], True), (["<name>a", "<name>b"], ["<name>c", "<name>c"], False),
        ([], [], True)], "a array<string>, b array<string>, want boolean")
    assert all(r.got == r.want for r in rows.select("want", decontaminate.consistent(F.col("a"), F.col("b")).alias("got")).collect())


def test_plain_words_are_classified_alike():
    """The classes found without a call per word are those of the call."""
    import random
    rng = random.Random(2)
    parts = ["a", "the", "B", "Be", "é", "ß", "É", "÷", "×", "km", "Five", "twenty", "7", "3.5", "10km", ".", "!", ",", ":", "(", "'", "-", "…", "“", "Ω", "ǅ", "李", "MIT", "\x00", "İ", "ﬁ"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(20_000)] + parts + sorted(decontaminate.MORE_UNITS | decontaminate.MORE_NUMBER_WORDS)
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, first = decontaminate.split_words(data, np.array([0, len(data)]))
    classes, known = decontaminate._plain_classes(data, starts, ends)
    want = decontaminate._coded([decontaminate._classify(data[a:b].tobytes()) for a, b in zip(starts, ends)])
    blank = want & np.uint64(7) == decontaminate.NOTHING
    assert known.mean() > 0.2 and np.array_equal(classes[known & ~blank], want[known & ~blank])
    assert np.array_equal(classes[known & blank] & np.uint64(7), want[known & blank] & np.uint64(7))
