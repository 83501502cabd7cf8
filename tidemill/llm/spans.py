"""Where a pattern matches, in code points, with column functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str, also: int | None = None, when: Column | None = None) -> Column:
    """array<struct<start, end, hit, part>>: all leftmost non-overlapping matches of ``pattern``.

    ``split`` and ``regexp_extract_all`` walk the same matches, so the lengths of the texts between
    and of the matches add up to positions. ``part`` is capture group ``also``, or the match itself.
    Where ``when`` is not true the pattern is not tried and the array is empty. The pattern must
    not match the empty string.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = hits if also is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(also))
    gaps = F.split(text, pattern, -1)
    walked = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), parts.alias("part")),
        F.struct(F.lit(0).alias("at"), empty().alias("out")),
        lambda state, x: F.struct(
            (state["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
            F.when(x["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(F.struct(
                (state["at"] + F.length(x["gap"])).alias("start"),
                (state["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                x["hit"].alias("hit"), x["part"].alias("part"))))).alias("out")),
        lambda state: state["out"])
    tried = F.rlike(text, F.lit(pattern)) if when is None else when & F.rlike(text, F.lit(pattern))
    return F.when(tried, walked).otherwise(empty())


def empty() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,hit:string,part:string>>)")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of array<struct<start, rank, kind, end>> in order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def tagged(found: Column, rank: int, kind: str) -> Column:
    """Matches as structs that sort by start, then by the rank of their kind."""
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))
