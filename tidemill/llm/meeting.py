"""Where do equal hashes meet? One shuffle that tells each document which of its hashes others hold too.

Tasks read documents, gather (hash, key) pairs and fold them: a hash that several documents of the task hold
is answered at once and sent on only once, so what a very common hash costs follows the number of tasks, not the
number of documents. Pairs travel packed in binary columns, one row per bucket of hashes and task; answers
go back the same way, one row per group of keys and task, and end as one row per key with its packed hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemill.llm.words import mix

PAIRS = 1_000_000        # pairs that a task folds at a time
BUCKETS_PER_PARTITION = 4
SENT = "bucket int, hashes binary, keys binary, counts binary"
PACKED = "bucket int, keys binary, vals binary"

Pairs = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def packed_rows(groups: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """(distinct group numbers, for each column its packed values per group)."""
    order = np.argsort(groups, kind="stable")
    groups = groups[order]
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.append(heads[1:], len(groups)).tolist()
    sorted_columns = [c[order] for c in columns]
    return groups[heads], [[pack(c[a:b]) for a, b in zip(heads.tolist(), ends)] for c in sorted_columns]


def _fold(hashes: np.ndarray, keys: np.ndarray):
    """Pairs in order of (hash, key), the heads of equal hashes, and the group of each pair."""
    order = np.lexsort((keys, hashes))
    hashes, keys = hashes[order], keys[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    sizes = np.diff(np.append(heads, len(hashes)))
    return hashes, keys, heads, np.repeat(np.arange(len(heads)), sizes), sizes


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_key_group(keys: np.ndarray, values: np.ndarray, groups: int) -> pa.RecordBatch:
    """PACKED rows: (key, value) pairs, one row for each group of keys among them."""
    if not len(keys):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.binary())], ["bucket", "keys", "vals"])
    found, (k, v) = packed_rows((mix(keys.view(np.uint64)) % np.uint64(groups)).astype(np.int64), keys, values)
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(k, pa.binary()), pa.array(v, pa.binary())], ["bucket", "keys", "vals"])


def regroup(packed: DataFrame, kind, width: int = 1) -> DataFrame:
    """(key, vals): PACKED rows as one row per key with all its packed values (``width`` numbers each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []
        for batch in batches:
            keys.append(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64))
            values.append(np.frombuffer(b"".join(batch.column(2).to_pylist()), kind).reshape(-1, width))
        if not sum(map(len, keys)):
            return
        keys, values = np.concatenate(keys), np.concatenate(values)
        found, (vals,) = packed_rows(keys, values)
        for a in range(0, len(found), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(found[a:a + 4096], pa.int64()), pa.array(vals[a:a + 4096], pa.binary())], ["key", "vals"])

    return packed.select("bucket", "keys", "vals").repartition("bucket").mapInArrow(run, "key bigint, vals binary")


def meet(rows: DataFrame, pairs: Pairs, first_too: bool, within: bool) -> DataFrame:
    """(key, vals): for each key the hashes that occur elsewhere too, packed uint64, in one row.

    ``pairs`` turns a task's batches into (hash, key) arrays. With ``within``, occurrences under one key count
    as different ones; else only different keys do. Without ``first_too`` the smallest key of a hash gets no answer.
    """
    groups = partitions(rows)
    buckets = BUCKETS_PER_PARTITION * groups

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for part in pairs(batches):
            waiting.append(part)
            size += len(part[0])
            if size >= PAIRS:
                yield from fold_out(waiting)
                waiting, size = [], 0
        if size:
            yield from fold_out(waiting)

    def fold_out(waiting) -> Iterator[pa.RecordBatch]:
        hashes, keys, heads, group, sizes = _fold(np.concatenate([h for h, _ in waiting]), np.concatenate([k for _, k in waiting]))
        lowest = keys[heads]
        several = sizes > 1 if within else keys[heads + sizes - 1] != lowest
        known = several[group]
        if not first_too:
            known &= keys > lowest[group]
        fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])])
        known &= fresh
        done = by_key_group(keys[known], hashes[known], groups)
        n = done.num_rows
        names = ["bucket", "hashes", "keys", "counts"]
        if n:
            yield pa.RecordBatch.from_arrays([done.column(0), done.column(2), done.column(1), pa.nulls(n, pa.binary())], names)
        where = ((hashes[heads] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        counts = several.astype(np.uint8) + 1
        found, (h, k, c) = packed_rows(where, hashes[heads], lowest, counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(found.astype(np.int32)), pa.array(h, pa.binary()), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            done = batch.filter(batch.column(3).is_null())
            if done.num_rows:  # answered on the way: it only changes trains here
                yield pa.RecordBatch.from_arrays([done.column(0), done.column(2), done.column(1)], ["bucket", "keys", "vals"])
            asked = batch.filter(batch.column(3).is_valid())
            parts.append(tuple(np.frombuffer(b"".join(asked.column(i).to_pylist()), kind)
                               for i, kind in ((1, np.uint64), (2, np.int64), (3, np.uint8))))
        if not parts or not sum(len(p[0]) for p in parts):
            return
        hashes, keys, counts = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        order = np.lexsort((keys, hashes))
        hashes, keys, counts = hashes[order], keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        sizes = np.diff(np.append(heads, len(hashes)))
        group = np.repeat(np.arange(len(heads)), sizes)
        several = np.maximum.reduceat(counts, heads) > 1
        several |= sizes > 1 if within else keys[heads + sizes - 1] != keys[heads]
        if first_too:  # a hash that several documents of its task hold has been answered there
            wanted = several[group] & (counts == 1)
        else:
            wanted = keys > keys[heads][group]
        yield by_key_group(keys[wanted], hashes[wanted], groups)

    sent = rows.mapInArrow(send, SENT)
    return regroup(sent.repartition("bucket").mapInArrow(answer, PACKED), np.uint64)


def unpack(packed, kind=np.uint64) -> np.ndarray:
    """The values of a packed scalar (null: none)."""
    return np.frombuffer(packed.as_buffer(), kind) if packed.is_valid else np.zeros(0, kind)
