"""The registered queries of this package, each over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, decontaminate, dialogue, imatch, manifest, near_dup, pii, quality, repeats, secret_scan, substring_dedup, token_counts, weak_rules
from tidemill.llm.common import stored
from tidemill.llm.sqltext import OP1, OP4, OP9, OP11, OP12

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer() -> tuple[bytes, str]:
    """The public vocabulary's rank file and its splitting pattern, read on the driver."""
    import public_tokenizers
    return bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query("op1_secret_scan", OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(documents(spark, sf_dir)))


@query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), ranks, pattern))


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op4_substring_dedup", OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    return token_counts.limits(token_counts.histogram(bpe.lengths(documents(spark, sf_dir), ranks, pattern)))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.statistics(documents(spark, sf_dir)), "statistics")
    return quality.scored(measured, quality.fit(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op7_repeats")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.extract(documents(spark, sf_dir)))


@query("op9_near_dup", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.link(documents(spark, sf_dir), words=2)


@query("op10_imatch")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare(documents(spark, sf_dir))


@query("op11_manifest", OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(documents(spark, sf_dir))


@query("op12_conversation_repair", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.damage_and_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op13_quality_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.report(weak_rules.judged(documents(spark, sf_dir)))
