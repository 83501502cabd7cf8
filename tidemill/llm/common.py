"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import scratch

SLICE_CHARS = 500_000  # bytes of text that a task works on at a time


def narrow(df: DataFrame, whole_row: bool = False, **wanted: str) -> DataFrame:
    """Only the wanted columns, under new names: ``narrow(docs, id="doc_id", text="text")``.

    Columns are found by exact name and position, so extra columns whose names clash with
    an operator's own, or differ from a wanted one in case only, do no harm. Of two columns
    with the same exact name the first counts. With ``whole_row`` all columns come along as struct ``row``.
    """
    names = df.columns
    places = {new: names.index(old) for new, old in wanted.items()}
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    row = [F.struct(*[F.col(f"_{i}").alias(name) for i, name in enumerate(names)]).alias("row")] if whole_row else []
    return plain.select(*[F.col(f"_{i}").alias(new) for new, i in places.items()], *row)


def whole_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with an empty text for a null one."""
    cut = narrow(df, id=id_col, text=text_col)
    return cut.select("id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to pieces of a bounded number of characters (a single row stays whole)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.zeros(batch.num_rows, np.int64)
        offsets = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) else np.int32,
                                count=batch.num_rows + 1, offset=col.offset * (8 if pa.types.is_large_string(col.type) else 4))
        sizes[:] = np.diff(offsets)
        group = np.cumsum(sizes) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column without nulls as one byte array and its row offsets."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32, count=len(col) + 1,
                            offset=col.offset * (8 if wide else 4)).astype(np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for all (s, n)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sha(col: Column) -> Column:
    return F.sha2(col, 256)


# While an intermediate table is written, shuffle files go with it and Arrow batches stay small.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    A lost executor then costs a re-read instead of the whole lineage. The shuffle files behind the
    write have served their purpose and are dropped with it. The session's own settings are restored.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(id, key, text), and whether several rows may share a key.

    The id is the key. Only where an id repeats (or is null) do keys come from id and text together; then rows equal
    in both share a key.
    """
    cut = whole_text(docs, id_col, text_col)
    again = cut.groupBy("id").count().where((F.col("count") > 1) | F.col("id").isNull())
    if again.isEmpty():
        return cut.select("id", F.col("id").cast("long").alias("key"), "text"), False
    return cut.select("id", hashed_key(F.col("id"), F.col("text")).alias("key"), "text"), True


def hashed_key(id_: Column, text: Column) -> Column:
    return F.xxhash64(id_, text)
