"""Record transforms that can be chained: each takes and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Transform = Callable[[DataFrame], DataFrame]


def insert_field(name: str, value: object = None, timestamp: bool = False) -> Transform:
    """Add a constant, or the processing time."""
    col = F.current_timestamp() if timestamp else F.lit(value)
    return lambda df: df.withColumn(name, col)


def replace_field(renames: Mapping[str, str] | None = None, include: Sequence[str] | None = None,
                  exclude: Sequence[str] = ()) -> Transform:
    """Keep or drop fields, then rename. ``include``/``exclude`` use the old names."""
    def run(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if (include is None or c in include) and c not in exclude]
        return df.select(*kept).withColumnsRenamed(dict(renames or {}))
    return run


def _blank(kind: T.DataType):
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    return F.lit(None).cast(kind)


def mask_field(*fields: str) -> Transform:
    """Blank a field without changing its type: 0, '' or false."""
    return lambda df: df.withColumns({f: _blank(df.schema[f].dataType) for f in fields})


def cast_field(types: Mapping[str, str]) -> Transform:
    """Change types; what does not fit becomes NULL."""
    return lambda df: df.withColumns({f: F.col(f).try_cast(t) for f, t in types.items()})


def flatten(delim: str = "_") -> Transform:
    """Nested structs become columns named parent<delim>child."""
    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(delim.join(here))
    return lambda df: df.select(*leaves(df.schema, ()))


def extract_field(field: str) -> Transform:
    """Replace the record by one of its fields; a struct spreads to its columns."""
    def run(df: DataFrame) -> DataFrame:
        struct = isinstance(df.select(field).schema[0].dataType, T.StructType)
        return df.select(f"{field}.*" if struct else field)
    return run


def filter_predicate(drop_when: Column) -> Transform:
    """Drop records for which the predicate is true; unknown keeps the record."""
    return lambda df: df.where(~F.coalesce(drop_when, F.lit(False)))


def timestamp_router(topic: Column, ts: Column, fmt: str = "yyyyMMdd", name: str = "topic") -> Transform:
    return lambda df: df.withColumn(name, F.concat_ws("-", topic, F.date_format(ts, fmt)))


def regex_router(topic: Column, pattern: str, replacement: str, name: str = "topic") -> Transform:
    return lambda df: df.withColumn(name, F.regexp_replace(topic, pattern, replacement))


def value_to_key(*cols: str, spread: int | None = None) -> Transform:
    """Copy value fields into a key struct; with ``spread``, re-key to that many partitions."""
    def run(df: DataFrame) -> DataFrame:
        out = df.withColumn("key", F.struct(*cols))
        return out.repartition(spread, *cols) if spread else out
    return run


def chain(*steps: Transform) -> Transform:
    return lambda df: reduce(lambda d, step: d.transform(step), steps, df)


def pipeline_stage(df: DataFrame, payload: str, source: str, valid_sources: Sequence[str]) -> DataFrame:
    """Validate, then enrich: each record gets its rejection reason or its measures."""
    blank = F.col(payload).isNull() | (F.btrim(payload, F.lit(" \t\n\r")) == "")
    reason = (F.when(blank, "rejected_empty_payload")
              .when(~F.coalesce(F.col(source).isin(*valid_sources), F.lit(False)), "rejected_bad_source"))
    words = F.size(F.filter(F.split(payload, "[ \t\n\r]+"), lambda w: w != ""))
    return (df.withColumn("reason", reason)
            .withColumn("word_count", F.when(F.col("reason").isNull(), words))
            .withColumn("char_count", F.when(F.col("reason").isNull(), F.length(payload))))


def pipeline_counters(staged: DataFrame) -> DataFrame:
    """One pass over the staged records to the counters of all stages."""
    passed = F.count_if(F.col("reason").isNull())
    wide = staged.agg(
        F.count("*").alias("received"),
        F.count_if(F.col("reason") == "rejected_empty_payload").alias("rejected_empty_payload"),
        F.count_if(F.col("reason") == "rejected_bad_source").alias("rejected_bad_source"),
        passed.alias("validated"), passed.alias("enriched"), passed.alias("completed"))
    return wide.unpivot([], wide.columns, "counter", "n")
