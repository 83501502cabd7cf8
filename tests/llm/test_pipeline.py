"""The pipeline against a plain version built from the operators' brute-force twins."""

import base64

import public_tokenizers as P
import tiktoken
from conftest import TESTDATA
from test_near_dup import brute as near
from test_secret_scan import expected as secrets

import corpus_pipeline
from tidemill.llm import near_dup, quality

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def masked(text):
    out, at = "", 0
    for start, _, _, end in secrets(text):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def leaked(text, windows):
    w = text.lower().split()
    return any(tuple(w[k:k + 13]) in windows for k in range(len(w) - 12))


def test_rows(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    model = quality.fit(quality.statistics(docs), labels)
    scores = {r.doc_id: r.score for r in quality.scored(quality.statistics(docs), model).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if scores[r.doc_id] >= 0.3]
    rows = [r for r, (_, _, _, kept) in zip(rows, near(rows, 5)) if kept]
    windows = set()
    for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect():
        w = r.text.lower().split()
        windows |= {tuple(w[k:k + 13]) for k in range(len(w) - 12)}
    want = {d: masked(t) for d, t in rows if not leaked(t, windows)}
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, TESTDATA).collect()}
    assert got.keys() == want.keys() and 0 < len(want) < docs.count()
    for d, r in got.items():
        assert r.decoded == want[d] and r.ids == library.encode_ordinary(want[d]) and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TESTDATA)
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), TESTDATA).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), TESTDATA).collect() == []


def test_odd_rows_go_through(spark):
    """Nulls in any column, repeated rows, an extra column with an operator's own name."""
    clean = "The of and to in is that for it as with was on be by this are from at an the of and to in a plain short text of words."
    rows = [(1, None, "en", "s", None, "x"), (None, clean, None, None, 3, None), (2, "token=abcdefghijklmn " + clean, "en", "s", 99, "k"),
            (2, "token=abcdefghijklmn " + clean, "en", "s", 99, "k"), (3, "", "en", "s", 0, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")
    out = corpus_pipeline.distinct(spark, docs, TESTDATA)
    assert out.columns == docs.columns
    kept = {(r.doc_id, r.key) for r in out.collect()}
    assert (1, "x") in kept and (3, "k") in kept and len([k for k in kept if k[0] == 2]) <= 1
    red = {(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.safe(spark, docs, TESTDATA).collect()}
    assert (2, "[secret] " + clean, len("[secret] " + clean)) in red and (1, None, None) in red and (None, clean, 3) in red
    assert corpus_pipeline.unleaked(spark, docs, TESTDATA).count() == 5
    assert corpus_pipeline.encoded(spark, docs, TESTDATA).count() == 5


def test_keep_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(5, base), (4, base + " x"), (4, "other words that stand on their own here"), (9, base), (9, base), (None, base)]
    out = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted([(4, base + " x"), (4, "other words that stand on their own here")])
