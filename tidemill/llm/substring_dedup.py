"""Substring dedup by difference-cover anchors.

With a difference cover D modulo v, any two positions have a common offset below v that takes both to cover
positions. So of two equal windows of ``window`` words, some anchor of ``window - v + 1`` words starts at a cover
position in both, at the same place. Anchors are hashed at cover positions only (three of seven for 13-word
windows). Anchors that two documents hold mark where windows can repeat; the match is then extended:
only windows around such anchors are hashed whole and meet the same windows of other documents.
A window that also starts in a document with a smaller id has its words removed.

Null texts have no words. A null id counts as larger than any other: its words go if a document with an id
holds them. Rows that repeat an id do not repeat each other; each gives one result row. Texts shorter than the
window lose nothing. Windows are compared by 64-bit hashes. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import ranges, slices, stored, text_bytes, whole_text
from tidemill.llm.meeting import meet, unpack
from tidemill.llm.words import row_of, split_words, starts_inside, window_hashes, word_hashes

# Difference covers by their modulus (perfect difference sets).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
LAST = 2 ** 63 - 1  # stands for a null id


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """(modulus, cover positions, anchor length): the largest cover that leaves anchors at least as long as the modulus."""
    v = max(m for m in COVERS if m <= (window + 1) // 2)
    return v, COVERS[v], window - v + 1


def _words(batch: pa.RecordBatch, column: int):
    data, offsets = text_bytes(batch.column(column))
    starts, ends, first = split_words(data, offsets)
    return data, starts, ends, first, word_hashes(data, starts, ends)


def _at_cover(first: np.ndarray, window: int) -> np.ndarray:
    """The first words of all anchors: cover positions, counted from each document's first word."""
    v, cover, size = cover_for(window)
    inside = starts_inside(first, size)
    place = inside - np.repeat(first[:-1], np.maximum(np.diff(first) - size + 1, 0))
    return inside[np.isin(place % v, cover)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    cut = whole_text(docs, id_col, text_col)
    return cut.select(F.coalesce(F.col("id").cast("long"), F.lit(LAST)).alias("key"), "text")


def anchors(keyed: DataFrame, window: int) -> DataFrame:
    """(key, vals): the anchors of each document that other documents hold at cover positions too."""
    size = cover_for(window)[2]

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            _, _, _, first, hashes = _words(batch, 1)
            at = _at_cover(first, window)
            if len(at):
                keys = np.asarray(batch.column(0))
                yield window_hashes(hashes, size)[at], np.repeat(keys, np.diff(np.searchsorted(at, first)))

    return meet(keyed, pairs, first_too=True, within=False)


def _members(values: np.ndarray, rows: np.ndarray, packed: pa.Array) -> np.ndarray:
    """Which values are among the packed ones of their row; rows are in order."""
    out = np.zeros(len(values), bool)
    cuts = np.searchsorted(rows, np.arange(len(packed) + 1)).tolist()
    for i, some in enumerate(packed):
        if cuts[i] < cuts[i + 1] and some.is_valid:
            out[cuts[i]:cuts[i + 1]] = np.isin(values[cuts[i]:cuts[i + 1]], unpack(some))
    return out


def repeated_windows(keyed: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """(key, vals): the windows of each document that also start in one with a smaller key."""
    v, _, size = cover_for(window)
    rows = keyed.join(shared, "key").select("key", "text", "vals")

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            _, _, _, first, hashes = _words(batch, 1)
            at = _at_cover(first, window)
            row = np.searchsorted(first, at, "right") - 1
            held = at[_members(window_hashes(hashes, size)[at] if len(at) else np.zeros(0, np.uint64), row, batch.column(2))]
            near = np.zeros(len(hashes) + 1, np.int64)  # windows that hold such an anchor start up to v - 1 words before it
            np.add.at(near, np.maximum(held - v + 1, 0), 1)
            np.add.at(near, held + 1, -1)
            inside = starts_inside(first, window)
            inside = inside[np.cumsum(near)[inside] > 0]
            if len(inside):
                keys = np.asarray(batch.column(0))
                yield window_hashes(hashes, window)[inside], keys[np.searchsorted(first, inside, "right") - 1]

    return meet(rows, pairs, first_too=False, within=False)


def dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by spaces."""
    keyed = _keyed(docs, id_col, text_col)
    shared = stored(anchors(keyed, window), "anchors")
    gone = stored(repeated_windows(keyed, shared, window), "windows")
    rows = keyed.join(gone, "key", "left").select("key", "text", "vals")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, starts, ends, first, hashes = _words(batch, 1)
            inside = starts_inside(first, window)
            row = np.searchsorted(first, inside, "right") - 1
            bad = inside[_members(window_hashes(hashes, window)[inside] if len(inside) else np.zeros(0, np.uint64), row, batch.column(2))]
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, bad, 1)
            np.add.at(cover, bad + window, -1)
            stays = np.cumsum(cover[:-1]) == 0
            of = row_of(first)
            kept = np.bincount(of[stays], minlength=batch.num_rows)
            words = np.diff(first)
            a, n = starts[stays], ends[stays] - starts[stays] + 1  # a word and the space after it
            text = np.append(data, np.uint8(32))[np.minimum(ranges(a, n), len(data))]
            text[np.cumsum(n) - 1] = 32
            sizes = np.bincount(of[stays], weights=n, minlength=batch.num_rows).astype(np.int64)
            last = np.cumsum(sizes)[sizes > 0] - 1  # no space after a document's last word
            text = np.delete(text, last)
            offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes - 1, 0))]).astype(np.int32)
            out = pa.Array.from_buffers(pa.string(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(words - kept, pa.int64()), out], ["key", "n_words", "n_removed", "kept"])

    done = rows.mapInArrow(cut, "key bigint, n_words bigint, n_removed bigint, kept string")
    return done.select(F.when(F.col("key") != LAST, F.col("key")).alias(id_col), "n_words", "n_removed", "kept")
