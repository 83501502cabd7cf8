"""User-defined functions for logic that has no native expression. All work on Arrow batches.

Where a native form exists (``scalar.mask_email``, ``aggregates.weighted_avg``, ``explode``)
it is the one to use; these show the shape a user's own logic takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mask_email_udf():
    """Vectorised scalar function: one Arrow batch of text in, one out."""
    @F.pandas_udf(T.StringType())
    def mask(s: pd.Series) -> pd.Series:
        at = s.str.find("@")
        masked = s.str[:1] + "***" + "@" + s.str.split("@", n=1).str[1]
        return s.where(s.isna() | (at <= 1), masked)
    return mask


def weighted_mean_partials() -> Callable[[DataFrame, list[str], str, str], DataFrame]:
    """Aggregate function in two steps, so that no task ever holds a whole group.

    A grouped-aggregate pandas function needs a group's rows together. Instead each Arrow
    batch yields (key, sum of w*v, sum of w), and a native sum folds those. Rows without a
    value or a weight do not count; a group of such rows has no result row.
    """
    def run(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
        kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                b = b[b[value].notna() & b[weight].notna()]
                b = b.assign(wv=b[value].astype("float64") * b[weight].astype("float64"), w=b[weight].astype("float64"))
                yield b.groupby(keys, as_index=False, dropna=False)[["wv", "w"]].sum()

        parts = df.select(*keys, value, weight).mapInPandas(partial, f"{kinds}, wv double, w double")
        return parts.groupBy(*keys).agg((F.sum("wv") / F.sum("w")).alias("weighted_mean"))
    return run


def split_words_udtf():
    """Table function: one text in, one row per word out."""
    @F.udtf(returnType="word: string, position: int", useArrow=True)
    class SplitWords:
        def eval(self, text: str):
            for i, w in enumerate((text or "").split()):
                yield w, i
    return SplitWords


def custom_check(test: Callable[[Column], Column], message: str) -> Callable[[str], Column]:
    """A user's own check: NULL when the value passes, the message when it fails."""
    def check(col: str) -> Column:
        return F.when(~F.coalesce(test(F.col(col)), F.lit(True)), F.lit(message))
    return check
