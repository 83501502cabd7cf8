"""Byte substrings that repeat anywhere in a corpus, removed by a run-length index.

1. Every window of ``window`` bytes selects its anchor: the gram with the smallest hash in it, the leftmost of equals.
   Equal windows select equal anchors at equal places, so only anchors that occur twice can hold repeats.
2. The stretch of bytes whose windows selected such an anchor travels to the bucket of the anchor's hash. Equal
   stretches are folded before and after the shuffle. Anchors with different stretches are indexed, bucket by bucket: a
   run-compressed Burrows-Wheeler transform with samples at run ends, from which the matching statistics of all its
   positions stream. Positions whose match is long enough mark their window.
3. The marks return to their documents, whose marked bytes go.

A bucket whose different stretches outgrow one task (a common gram in very many surroundings) is not indexed: its
windows meet by hash in a shuffle of their own, without a limit.

Null texts are empty; texts shorter than the window lose nothing. Rows that repeat an id are documents
of their own, and so repeat each other. Each input row gives one result row. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import ranges, row_keys, slices, stored, text_bytes
from tidemill.llm.meeting import PACKED, by_key_group, meet, pack, partitions, regroup, unpack
from tidemill.llm.rlbwt import SEPARATOR, RunIndex
from tidemill.llm.words import prefix_hash, stretch_hash

GRAM_SHARE = 4            # an anchor is a quarter as long as a window
CHUNK = 1 << 19           # window starts handled at a time
PLACE_BITS = 22
STRETCHES = 40_000        # stretches that a task folds at a time
INDEX_BYTES = 1 << 20     # buckets are indexed together up to about this size ...
BUCKET_BYTES = 4 << 20    # ... and a bucket of more different bytes than this meets by window hashes
BUCKETS_PER_PARTITION = 32
STRETCH = "bucket int, keys binary, vals binary, starts binary, sizes binary, counts binary, bytes binary, anchors binary"
MARKS = PACKED + ", sizes binary, bytes binary"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2 ** 64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchors_of(data: np.ndarray, offsets: np.ndarray, window: int):
    """(row, hash, first, last): every anchor of every row, and the first and last window start that select it."""
    gram = max(1, window // GRAM_SHARE)
    low = np.uint64((1 << PLACE_BITS) - 1)
    parts = []
    for c in range(0, max(len(data) - window + 1, 0), CHUNK):
        piece = data[c:c + CHUNK + window - 1]
        at = np.arange(len(piece) - gram + 1)
        hashes = stretch_hash(prefix_hash(piece), at, at + gram)
        best = _sliding_min(hashes & ~low | at.astype(np.uint64), window - gram + 1)
        starts = np.arange(c, c + len(best))
        row = np.searchsorted(offsets, starts, "right") - 1
        inside = starts + window <= offsets[row + 1]
        starts, row, place = starts[inside], row[inside], (best[inside] & low).astype(np.int64)
        if not len(starts):
            continue
        head = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
        tail = np.append(head[1:], True)
        parts.append((row[head], hashes[place[head]], starts[head], starts[tail], place[head] + c))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    row, hashes, first, last, place = (np.concatenate(x) for x in zip(*parts))
    head = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])  # an anchor may go on in the next chunk
    return row[head], hashes[head], first[head], last[np.append(head[1:], True)]


def shared_anchors(keyed: DataFrame, window: int) -> DataFrame:
    """(key, vals): the anchors of each document that occur elsewhere too, itself included."""

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            row, hashes, _, _ = anchors_of(*text_bytes(batch.column(1)), window)
            if len(row):
                yield hashes, np.asarray(batch.column(0))[row]

    return meet(keyed.select("key", "text"), pairs, first_too=True, within=True)


def stretches(keyed: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """The stretches around shared anchors, packed per bucket; those repeated within a task also as marks of their keys."""
    groups = partitions(keyed)
    buckets = BUCKETS_PER_PARTITION * groups
    rows = keyed.join(shared, "key").select("key", "text", "vals")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int, int, int]] = []
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            keys = np.asarray(batch.column(0))
            row, hashes, first, last = anchors_of(data, offsets, window)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
            wanted = np.zeros(len(row), bool)
            for i, some in enumerate(batch.column(2)):
                wanted[cuts[i]:cuts[i + 1]] = np.isin(hashes[cuts[i]:cuts[i + 1]], unpack(some))
            where = ((hashes >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            for i in np.flatnonzero(wanted).tolist():
                a, b = int(first[i]), int(last[i]) + window
                held.append((int(where[i]), data[a:b].tobytes(), int(keys[row[i]]), a - int(offsets[row[i]]), int(hashes[i])))
            if len(held) >= STRETCHES:
                yield from fold(held)
                held = []
        if held:
            yield from fold(held)

    def fold(held) -> Iterator[pa.RecordBatch]:
        equal: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        for i, (bucket, text, *_) in enumerate(held):
            equal[bucket, hashlib.blake2b(text, digest_size=16).digest()].append(i)
        marks = [i for places in equal.values() if len(places) > 1 for i in places]
        if marks:
            keys = np.array([held[i][2] for i in marks], np.int64)
            starts = np.array([held[i][3] for i in marks], np.int64)
            done = by_key_group(keys, np.column_stack([starts, starts + [len(held[i][1]) for i in marks]]), groups)
            none = pa.nulls(done.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*done.columns, none, none, none, none, none], NAMES)
        by_bucket: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for (bucket, _), places in equal.items():
            by_bucket[bucket].append((places[0], min(len(places), 2)))
        columns: list[list[bytes]] = [[], [], [], [], [], []]
        for places in by_bucket.values():
            some = [held[i] for i, _ in places]
            columns[0].append(pack(np.array([s[2] for s in some], np.int64)))
            columns[1].append(pack(np.array([s[3] for s in some], np.int64)))
            columns[2].append(pack(np.array([len(s[1]) for s in some], np.int32)))
            columns[3].append(pack(np.array([n for _, n in places], np.uint8)))
            columns[4].append(b"".join(s[1] for s in some))
            columns[5].append(pack(np.array([s[4] for s in some], np.uint64)))
        n = len(by_bucket)
        packed = [pa.array(c, pa.binary()) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array(list(by_bucket), pa.int32()), packed[0], pa.nulls(n, pa.binary()), *packed[1:]], NAMES)

    return rows.mapInArrow(send, STRETCH)


NAMES = ["bucket", "keys", "vals", "starts", "sizes", "counts", "bytes", "anchors"]


def _indexed(stretch: list[tuple[int, int, bytes, int, int]], window: int):
    """Marks (keys, starts, ends) of stretches (key, start, bytes, count, anchor) that share their buckets.

    Equal windows have one anchor, so an anchor with one stretch, however often, has nothing to look up.
    """
    equal: dict[tuple[int, bytes], list[int]] = defaultdict(list)
    for i, (_, _, text, _, anchor) in enumerate(stretch):
        equal[anchor, text].append(i)
    different = Counter(anchor for anchor, _ in equal)
    keys, starts, ends = [], [], []
    pieces = []
    for (anchor, text), places in equal.items():
        if len(places) > 1 or stretch[places[0]][3] > 1:
            for i in places:
                keys.append(stretch[i][0])
                starts.append(stretch[i][1])
                ends.append(stretch[i][1] + len(text))
        if different[anchor] > 1:
            pieces.append(stretch[places[0]])
    if not pieces:
        return np.array(keys, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)
    pieces.sort(key=lambda p: (p[0], p[1]))
    regions: list[tuple[int, int, bytearray]] = []  # what one document sent, each byte of it once
    for key, start, text, *_ in pieces:
        if regions and regions[-1][0] == key and start <= regions[-1][1] + len(regions[-1][2]):
            have = regions[-1][1] + len(regions[-1][2])
            regions[-1][2].extend(text[max(have - start, 0):])
        else:
            regions.append((key, start, bytearray(text)))
    sizes = np.array([len(r[2]) for r in regions], np.int64)
    heads = np.cumsum(sizes + 1) - sizes - 1
    text = np.full(int(sizes.sum()) + len(regions), SEPARATOR, np.int64)
    text[ranges(heads, sizes)] = np.frombuffer(b"".join(bytes(r[2]) for r in regions), np.uint8)
    long = np.flatnonzero(RunIndex(text).matching_statistics() >= window)
    if len(long):
        region = np.searchsorted(heads, long, "right") - 1
        head = np.concatenate([[True], (long[1:] != long[:-1] + 1) | (region[1:] != region[:-1])])
        a, b, r = long[head], long[np.append(head[1:], True)], region[head]
        shift = np.array([r[1] for r in regions], np.int64)[r] - heads[r]
        keys += np.array([r[0] for r in regions], np.int64)[r].tolist()
        starts += (a + shift).tolist()
        ends += (b + shift + window).tolist()
    return np.array(keys, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)


def marked(sent: DataFrame, window: int) -> DataFrame:
    """Marks (start, end) from all buckets, packed by key; the rows of buckets too large to index come back as they are (vals null)."""
    groups = partitions(sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, bytes, int, int]] = []
        waiting_bytes = 0
        rows: list[tuple] = []    # of the bucket being read
        different: dict[bytes, int] = {}
        bucket, over = None, False

        def unpacked(row):
            _, keys, starts, sizes, counts, blob, anchors = row
            at = 0
            for key, start, size, count, anchor in zip(*(np.frombuffer(x, t).tolist() for x, t in (
                    (keys, np.int64), (starts, np.int64), (sizes, np.int32), (counts, np.uint8), (anchors, np.uint64)))):
                yield key, start, blob[at:at + size], count, anchor
                at += size

        def out(some):
            keys, starts, ends = _indexed(some, window)
            done = by_key_group(keys, np.column_stack([starts, ends]), groups)
            none = pa.nulls(done.num_rows, pa.binary())
            return pa.RecordBatch.from_arrays([*done.columns, none, none], OUT)

        def back(some):
            bucket, keys, _, sizes, _, blob, _ = zip(*some)
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(keys, pa.binary()), pa.nulls(len(some), pa.binary()),
                                               pa.array(sizes, pa.binary()), pa.array(blob, pa.binary())], OUT)

        for batch in batches:
            done = batch.filter(batch.column(2).is_valid())
            if done.num_rows:  # marked on the way
                none = pa.nulls(done.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([*done.columns[:3], none, none], OUT)
            for row in zip(*(batch.filter(batch.column(2).is_null()).column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6, 7))):
                if row[0] != bucket:
                    for r in rows:
                        waiting.extend(unpacked(r))
                    waiting_bytes += sum(different.values())
                    rows, different, over, bucket = [], {}, False, row[0]
                    if waiting_bytes >= INDEX_BYTES:
                        yield out(waiting)
                        waiting, waiting_bytes = [], 0
                if not over:
                    rows.append(row)
                    different.update((hashlib.blake2b(s[2], digest_size=16).digest(), len(s[2])) for s in unpacked(row))
                    if sum(different.values()) > BUCKET_BYTES:
                        yield back(rows)
                        rows, different, over = [], {}, True
                else:
                    yield back([row])
        for r in rows:
            waiting.extend(unpacked(r))
        if waiting:
            yield out(waiting)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, MARKS)


OUT = ["bucket", "keys", "vals", "sizes", "bytes"]


def window_meeting(back: DataFrame, window: int) -> DataFrame:
    """(key, vals): repeated windows of the stretches that were not indexed."""

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for keys, sizes, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys, sizes = np.frombuffer(keys, np.int64), np.frombuffer(sizes, np.int32).astype(np.int64)
                many = sizes - window + 1
                at = ranges(np.cumsum(sizes) - sizes, many)
                prefix = prefix_hash(np.frombuffer(blob, np.uint8))
                yield stretch_hash(prefix, at, at + window), np.repeat(keys, many)

    return meet(back.select("keys", "sizes", "bytes"), pairs, first_too=True, within=True)


def remove(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` binary."""
    keyed, repeated = row_keys(docs, id_col, text_col)
    shared = stored(shared_anchors(keyed, window), "repeat-anchors")
    found = stored(marked(stretches(keyed, shared, window), window), "repeat-marks")
    marks = regroup(found.where("vals is not null"), np.int64, 2).withColumnRenamed("vals", "spans")
    more = window_meeting(found.where("vals is null"), window).withColumnRenamed("vals", "hashes")
    rows = keyed.join(marks.join(more, "key", "full"), "key", "left")
    if repeated:
        copies = keyed.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("copied"))
        rows = rows.join(copies, "key", "left")
    else:
        rows = rows.withColumn("copied", F.lit(False))
    id_type = keyed.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            n = batch.num_rows
            edge = np.zeros(len(data) + 1, np.int64)
            whole = np.asarray(batch.column(4).fill_null(False))
            for i, (spans, hashes) in enumerate(zip(batch.column(2), batch.column(3))):
                a, b = int(offsets[i]), int(offsets[i + 1])
                if whole[i] and b - a >= window:
                    edge[a] += 1
                    edge[b] -= 1
                    continue
                pairs = unpack(spans, np.int64).reshape(-1, 2)
                np.add.at(edge, a + pairs[:, 0], 1)
                np.add.at(edge, a + pairs[:, 1], -1)
                if hashes.is_valid and b - a >= window:
                    at = np.arange(b - a - window + 1)
                    hit = a + at[np.isin(stretch_hash(prefix_hash(data[a:b]), at, at + window), unpack(hashes))]
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[offsets[1:]] - total[offsets[:-1]]
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = offsets[:-1][np.diff(offsets) > 0]
            begins[inner] = gone[inner]
            total = np.concatenate([[0], np.cumsum(begins)])
            runs = total[offsets[1:]] - total[offsets[:-1]]
            sizes = np.diff(offsets)
            ends = np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[~gone].tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(runs, pa.int64()), kept], [id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("id", "text", "spans", "hashes", "copied").mapInArrow(
        cut, f"`{id_col}` {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
