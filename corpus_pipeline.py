"""A training corpus in five stages: quality, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is written as Parquet and
read again as the next one's input. All but the last return the columns of ``documents``.

SQL cannot express the classifier, MinHash or BPE, so there is no SQL twin; ``tests/llm/test_pipeline.py`` compares
the rows with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, decontaminate, near_dup, quality, secret_scan
from tidemill.llm.common import stored
from tidemill.llm.queries import tokenizer

ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold. The model learns from labelled documents outside the held-out fold.

    Null and empty texts have the score of an empty text; rows without an id are scored but not learned from; repeated rows are
    kept or dropped together. Without documents, or without labels, nothing fails: see ``quality``.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.statistics(docs), labels)
    return docs.where(quality.keeps(model, docs["text"]))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    The smallest id of a group stays (a null id only if there is no other), and of repeated rows one. Documents without words, null texts
    among them, are near duplicates of nothing and stay, equal rows once.
    """
    return near_dup.keep_one(docs, words=5, percent=80)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, be it with other numbers, names or units.

    Null and empty texts have no passages and stay; a text counts wherever it stands, so repeated rows and null ids share its fate. Without
    benchmark items all documents stay.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def safe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts.

    A document without secrets comes back as it is, a null text as null; repeated rows are masked alike; ids may be null.
    """
    return secret_scan.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the tokens of every text, and the text they decode to.

    Null and empty texts have no tokens and decode to the empty text; every row gives a row, repeated ones and those without an id too.
    """
    ranks, pattern = tokenizer()
    both = bpe.round_trip(docs, ranks, pattern)
    return both.selectExpr("doc_id", "cast(size(ids) as bigint) as n_tokens", "ids", "cast(decoded as string) as decoded")


STAGES = [
    ("quality classifier", good),
    ("MinHash near-dedup", distinct),
    ("benchmark decontamination", unleaked),
    ("secret scans", safe),
    ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
