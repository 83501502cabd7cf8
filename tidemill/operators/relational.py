"""Projections, filters, sorting and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def select_computed(df: DataFrame, keep: Sequence[str], computed: Mapping[str, Column]) -> DataFrame:
    return df.select(*keep, *[c.alias(name) for name, c in computed.items()])


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


COMPARISONS = {
    "=": Column.__eq__, "!=": Column.__ne__, ">": Column.__gt__,
    ">=": Column.__ge__, "<": Column.__lt__, "<=": Column.__le__,
}


def filter_compare(df: DataFrame, *terms: tuple[str, str, object]) -> DataFrame:
    """Keep rows meeting every (column, operator, value) term."""
    tests = [COMPARISONS[op](F.col(c), F.lit(v)) for c, op, v in terms]
    return df.where(reduce(Column.__and__, tests))


def filter_in(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """IN list. Literals are cast to the column's type, so '7' matches an INT 7."""
    kind = df.schema[col].dataType
    return df.where(F.col(col).isin(*[F.lit(v).cast(kind) for v in values]))


def filter_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(F.col(col).like(pattern))


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def filter_not_null(df: DataFrame, *cols: Column | str) -> DataFrame:
    tests = [(F.col(c) if isinstance(c, str) else c).isNotNull() for c in cols]
    return df.where(reduce(Column.__and__, tests))


def tier_case(c: Column, bounds: Sequence[tuple[float, str]], default: str, above: bool = False) -> Column:
    """First matching tier: value < bound (or > bound with ``above``), else the default."""
    out = F
    for bound, label in bounds:
        out = out.when(c > bound if above else c < bound, F.lit(label))
    return out.otherwise(F.lit(default))


def filter_finite(df: DataFrame, number: str, key: str, status: str, allowed: Sequence[str]) -> DataFrame:
    n = F.col(number)
    finite = ~F.isnan(n) & (F.abs(n) < F.lit(float("inf")))
    return df.where(n.isNotNull() & finite & F.col(key).isNotNull() & F.col(status).isin(*allowed))


def ratio_filter(df: DataFrame, part: Column, whole: Column, pct: float) -> DataFrame:
    """Keep rows where part / whole * 100 exceeds ``pct``; a zero whole never passes."""
    return df.where(part / F.nullif(whole, F.lit(0.0)) * 100 > pct)


def late_record_filter(df: DataFrame, created: str, ingested: str, hours: float, keep: str = "on_time") -> DataFrame:
    """Split by ingest lag: ``on_time`` keeps lag <= hours, ``late`` keeps the others."""
    lag = F.unix_timestamp(F.col(ingested).cast("timestamp")) - F.unix_timestamp(F.col(created).cast("timestamp"))
    on_time = lag <= hours * 3600
    if keep not in ("on_time", "late"):
        raise ValueError("keep must be 'on_time' or 'late'")
    return df.where(on_time if keep == "on_time" else ~on_time)


def order_by(df: DataFrame, *by: Column) -> DataFrame:
    return df.orderBy(*by)


def top_n(df: DataFrame, by: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY .. LIMIT n: each partition keeps n rows before one task merges them."""
    return df.orderBy(*by).limit(n)


def top_n_per_group(df: DataFrame, keys: Sequence[str], by: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """The n first rows of each group.

    The filter sits directly on row_number, so every partition keeps only n rows per
    group before the shuffle; a group holding most of the table still moves few rows.
    """
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), others, first)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset difference both ways; an empty result means the two tables are equal."""
    cols = sorted(a.columns)
    a, b = a.select(cols), b.select(cols)
    return (a.exceptAll(b).withColumn("side", F.lit("left"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right"))))


def merge_heterogeneous(sources: Sequence[tuple[DataFrame, Mapping[str, Column]]], schema: Mapping[str, str]) -> DataFrame:
    """Union sources of different shape under one schema; what a source lacks is NULL."""
    parts = []
    for df, mapping in sources:
        cols = [(mapping[c] if c in mapping else F.lit(None)).cast(t).alias(c) for c, t in schema.items()]
        parts.append(df.select(*cols))
    return union_all(*parts)
