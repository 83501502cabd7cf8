"""Byte-level BPE: whole texts to token ids and back.

Texts are cut by the vocabulary's pattern, and each distinct piece of a slice is encoded once.
Pieces of similar byte length share a padded matrix with one row per piece. In each round every
row merges its leftmost pair of minimum rank: ranks come from an open-addressing hash table over
(left id, right id), the merged column is squeezed out, and finished rows leave the matrix.
Pieces longer than the widest matrix are merged one by one with a heap, with the same result.

Null texts count as empty and give no tokens. Repeated rows and ids give one result row each;
a null id stays null. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import ranges, slices, whole_text

NONE = np.int32(2 ** 31 - 1)  # rank of a pair that does not merge
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 128, 256)  # matrix widths; longer pieces go to the heap
CACHE_PIECES = 100_000  # pieces whose ids a worker remembers; only speed depends on it
CHUNK_PIECES = 100_000
SPLIT_CHARS = 1_000_000  # longer texts are cut into pieces a chunk at a time


def load(path: str) -> bytes:
    """The bytes of a rank file, as ``encode`` and ``decode`` take them (read on the driver)."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """Token bytes by id, and the hash table from id pairs to the id of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        top = max(ranks.values()) + 1
        by_id = [b""] * top
        for token, rank in ranks.items():
            by_id[rank] = token
        lengths = np.array([len(t) for t in by_id], np.int64)
        self.token_lengths = lengths
        self.token_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self._fill(np.array(keys, np.uint64), np.array(values, np.int32))
        self.reset()

    def reset(self) -> None:
        self.seen: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(8, int(4 * max(1, len(keys))).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, np.uint64(2 ** 64 - 1))
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slots = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] == np.uint64(2 ** 64 - 1)
            first = np.zeros(len(left), bool)
            first[np.unique(slots[left], return_index=True)[1]] = True
            put = left[free & first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = left[~(free & first)]
            slots[left] = (slots[left] + 1) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, or NONE; an id below zero is padding."""
        keys = left.astype(np.uint64) << np.uint64(32) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2 ** 64 - 1)))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found != np.uint64(2 ** 64 - 1))]
        out[(left < 0) | (right < 0)] = NONE
        return out

    def _merge_matrix(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, final id matrix) of the rows of a padded matrix as they finish."""
        rows = np.arange(len(ids))
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while len(rows):
            if ranks.shape[1] == 0:
                yield rows, ids
                return
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            over = best == NONE
            if over.any():
                yield rows[over], ids[over]
                go = ~over
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    return
            n, width = ids.shape
            every = np.arange(n)
            ids[every, at] = best
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(n, width - 2)
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self.pair_ranks(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pair_ranks(ids[left, at[left] - 1], ids[left, at[left]])

    def _merge_long(self, piece: bytes) -> list[int]:
        """One piece by a heap over its pairs: the same merges, n log n."""
        parts: list[bytes | None] = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := self.ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has changed since
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                joined = parts[i] + parts[after[i]]
                if joined in self.ranks:
                    heapq.heappush(heap, (self.ranks[joined], i, len(joined)))
            if before[i] >= 0:
                joined = parts[before[i]] + parts[i]
                if joined in self.ranks:
                    heapq.heappush(heap, (self.ranks[joined], before[i], len(joined)))
        return [self.ranks[p] for p in parts if p is not None]

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(piece) > WIDTHS[-1]:
                out[i] = np.array(self._merge_long(piece), np.int32)
        todo = np.array([i for i, x in enumerate(out) if x is None], np.int64)
        if len(todo):
            bucket = np.searchsorted(WIDTHS, sizes[todo])
            for b in np.unique(bucket):
                width = WIDTHS[b]
                members = todo[bucket == b]
                step = max(1, 1_000_000 // width)
                for a in range(0, len(members), step):
                    some = members[a:a + step]
                    raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in some), np.uint8)
                    ids = self.of_byte[raw].reshape(len(some), width)
                    ids[np.arange(width) >= sizes[some][:, None]] = -1
                    for rows, final in self._merge_matrix(ids):
                        real = final >= 0
                        cuts = np.cumsum(real.sum(1))[:-1]
                        for i, tokens in zip(some[rows].tolist(), np.split(final[real], cuts)):
                            out[i] = tokens
        return out

    def _learn(self, fresh: list[str]) -> None:
        results = self.merge([p.encode("utf-8") for p in fresh])
        lengths = np.array([len(r) for r in results], np.int64)
        first, need = len(self.seen), int(lengths.sum())
        while self.used + need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(fresh) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used:self.used + need] = np.concatenate(results)
        self.starts[first:first + len(fresh)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:first + len(fresh)] = lengths
        self.used += need
        self.seen.update(zip(fresh, range(first, first + len(fresh))))

    def places(self, pieces: list[str]) -> np.ndarray:
        """Where each piece's ids are in ``starts`` and ``lengths``."""
        fresh = list(set(pieces).difference(self.seen))
        if fresh:
            if len(self.seen) + len(fresh) > CACHE_PIECES and self.seen:
                self.reset()
                fresh = list(set(pieces))
            self._learn(fresh)
        return np.fromiter(map(self.seen.__getitem__, pieces), np.int64, len(pieces))


_LOADED: dict[bytes, Vocabulary] = {}


def vocabulary(blob: bytes) -> Vocabulary:
    key = hashlib.blake2b(blob, digest_size=16).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a})
    return _LOADED[key]


def encode_texts(vocab: Vocabulary, pattern: str, texts: list[str], only_lengths: bool = False):
    """(ids of all texts or None, number of ids of each text)."""
    cut = regex.compile(pattern)
    ids, counts = [], np.zeros(len(texts), np.int64)
    pieces: list[str] = []
    owners: list[tuple[int, int]] = []

    def flush():
        if pieces:
            places = vocab.places(pieces)
            lengths = vocab.lengths[places]
            np.add.at(counts, np.repeat([o for o, _ in owners], [n for _, n in owners]), lengths)
            if not only_lengths:
                ids.append(vocab.flat[ranges(vocab.starts[places], lengths)])
        pieces.clear()
        owners.clear()

    for i, text in enumerate(texts):
        if len(text) < SPLIT_CHARS:
            found = cut.findall(text)
            pieces.extend(found)
            owners.append((i, len(found)))
        else:  # a very long text, a chunk of pieces at a time
            walk = cut.finditer(text)
            while found := [m.group() for m in islice(walk, CHUNK_PIECES)]:
                flush()
                pieces.extend(found)
                owners.append((i, len(found)))
        if len(pieces) >= CHUNK_PIECES:
            flush()
    flush()
    return (None if only_lengths else np.concatenate(ids) if ids else np.zeros(0, np.int32)), counts


def decode_ids(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of each run of ids, as a binary column."""
    ids = ids.astype(np.int64)
    widths = vocab.token_lengths[ids]
    data = vocab.token_bytes[ranges(vocab.token_starts[ids], widths)]
    ends = np.concatenate([[0], np.cumsum(widths)])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _encoder(ranks, pattern: str, only_lengths: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks.value)
        for batch in slices(batches):
            ids, counts = encode_texts(vocab, pattern, batch.column(1).to_pylist(), only_lengths)
            if only_lengths:
                out = pa.array(counts, pa.int64())
            else:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["id", "out"])

    return run


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``ids`` array<int>, the tokens of the whole text."""
    cut = whole_text(docs, id_col, text_col)
    schema = T.StructType([T.StructField("id", cut.schema["id"].dataType), T.StructField("out", T.ArrayType(T.IntegerType()))])
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file: its size does not follow the data
    return cut.mapInArrow(_encoder(shared, pattern, False), schema).select(F.col("id").alias(id_col), F.col("out").alias("ids"))


def lengths(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``n_tokens`` bigint, the length ``encode`` would give."""
    cut = whole_text(docs, id_col, text_col)
    schema = T.StructType([T.StructField("id", cut.schema["id"].dataType), T.StructField("out", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    return cut.mapInArrow(_encoder(shared, pattern, True), schema).select(F.col("id").alias(id_col), F.col("out").alias("n_tokens"))


def decode(tokens: DataFrame, ranks: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The rows of ``tokens`` (``id_col``, ``ids_col``) with ``decoded`` binary, the bytes of the ids. Null ids give no bytes."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([tokens.schema[id_col], tokens.schema[ids_col], T.StructField("decoded", T.BinaryType())])
    names = [id_col, ids_col, "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # a bounded number of tokens at a time
                batch = whole.slice(at, 256)
                col = batch.column(1)
                sizes = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
                out = decode_ids(vocab, np.asarray(col.flatten()), sizes)
                yield pa.RecordBatch.from_arrays([batch.column(0), col, out], names)

    return tokens.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and then ``decode`` of its ids in one pass over the texts: ``id_col``, ``ids``, ``decoded``."""
    cut = whole_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(shared.value)
        for batch in slices(batches):
            ids, counts = encode_texts(vocab, pattern, batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, decode_ids(vocab, ids, counts)], ["id", "ids", "decoded"])

    return cut.mapInArrow(run, T.StructType([cut.schema["id"], *fields])).select(F.col("id").alias(id_col), "ids", "decoded")


def digests(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of tokens, and the digests of the ids and of the decoded bytes."""
    return tokens.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
