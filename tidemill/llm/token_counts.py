"""Token counts for every context limit from one exact histogram of encoded lengths.

Documents are folded to (length, documents) rows; suffix and prefix sums over the histogram then
give, for a limit equal to each length, how many documents fit, how many are longer, the tokens
of the whole corpus and those left after truncation. Any other limit follows from the next
shorter length (``answers``). The sums run inside blocks of lengths, and over one row per block,
so no task sees more than a block or the list of blocks.

Null texts count as empty (length 0); repeated rows count each time; an empty table has an
empty histogram. Ids are not read, so null or repeated ids change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import stored

BLOCK = 1024  # lengths per block


def histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """(length, n_docs) of all documents."""
    return lengths.groupBy(F.col(length_col).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """One row per length L of the histogram, read as a context limit:

    n_docs documents of exactly L tokens; docs_up_to and tokens_up_to those of at most L;
    docs_over and tokens_over those longer; truncated_total the tokens left when every document
    is cut to L; quantile the share of documents of at most L tokens.
    """
    block = F.floor(F.col("length") / BLOCK).cast("long")
    hist = stored(hist, "histogram")  # read twice below
    rows = hist.withColumn("block", block).withColumn("tokens", F.col("length") * F.col("n_docs"))
    sums = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per 1024 lengths
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = sums.select(
        "block", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.sum("d").over(whole).alias("all_d"), F.sum("t").over(whole).alias("all_t"))
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(base, "block").select(
        "length", "n_docs", (F.col("d0") + F.sum("n_docs").over(inside)).alias("docs_up_to"),
        (F.col("t0") + F.sum("tokens").over(inside)).alias("tokens_up_to"), "all_d", "all_t")
    over = F.col("all_d") - F.col("docs_up_to")
    return out.select(
        "length", "n_docs", "docs_up_to", "tokens_up_to", over.alias("docs_over"),
        (F.col("all_t") - F.col("tokens_up_to")).alias("tokens_over"),
        (F.col("tokens_up_to") + F.col("length") * over).alias("truncated_total"),
        (F.col("docs_up_to") / F.col("all_d")).alias("quantile"))


def answers(table: DataFrame, asked: list[int]) -> DataFrame:
    """docs_up_to, docs_over and truncated_total for any context limits, from the rows of ``limits``.

    A limit between two lengths keeps the documents up to the shorter one and cuts the rest.
    """
    from_hist = [
        table.agg(
            F.lit(limit).cast("long").alias("context_limit"),
            F.coalesce(F.max(F.when(F.col("length") <= limit, F.col("docs_up_to"))), F.lit(0)).alias("docs_up_to"),
            F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
            F.coalesce(F.sum(F.least("length", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("truncated_total"))
        for limit in asked]
    out = from_hist[0]
    for part in from_hist[1:]:
        out = out.unionByName(part)
    return out


def quantile(table: DataFrame, share: float) -> DataFrame:
    """The shortest length that at least ``share`` of the documents do not exceed: one row ``length``."""
    return table.where(F.col("quantile") >= share).agg(F.min("length").alias("length"))
