"""Near duplicates: banded MinHash candidates, sequential Bayesian verification, exact check, components.

Documents with equal shingle sets form a class and are linked as such; only the member with the smallest key goes
on. Signatures are cut into bands; representatives that share a band value are candidates. A
candidate pair's signatures are compared batch by batch: after each, the pair is dropped if the posterior
probability (uniform prior) that its similarity reaches the threshold is below MISS. Survivors are compared on
their full sets of 64-bit shingle hashes.

No bucket's pairs are spelled out. First every member meets two centres of its bucket, which joins most of a large
group of copies. Then, in buckets that still hold several components, members outside the bucket's
largest component meet all others, in blocks of at most about BLOCK by BLOCK members, each pair in the first band
it shares. So every pair that shares a band and is not yet connected is compared; only the bands
themselves can miss one (at similarity 0.8 with a chance of 3e-6).

A null text, or one without words, has an empty set and is linked with nothing. Rows with the same id are documents of
their own, but an id is kept or not as a whole. A null id belongs to a component without naming it; a component of
null ids only has a null id and keeps its rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import hashed_key, narrow, row_keys, slices, stored, text_bytes
from tidemill.llm.meeting import meet
from tidemill.llm.words import LOWER, mix, row_of, split_words, window_hashes, word_hashes

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32       # hashes compared at a time
MISS = 1e-5      # posterior probability of a link at which a pair is dropped
BLOCK, BLOCK_SHINGLES = 512, 1 << 18
_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64), 7).astype(np.uint32)
FACTORS, SHIFTS = _SEEDS[:HASHES] | np.uint32(1), _SEEDS[HASHES:]


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by both; a text with fewer words has one shingle of all."""
    low = LOWER[data]
    starts, ends, first = split_words(low, offsets)
    hashes, of, count = word_hashes(low, starts, ends), row_of(first), np.diff(first)
    at = np.flatnonzero(np.arange(len(of)) + words <= first[1:][of]) if len(of) else np.zeros(0, np.int64)
    found, rows = window_hashes(hashes, words)[at] if len(at) else np.zeros(0, np.uint64), of[at]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        whole = [window_hashes(hashes[first[i]:first[i + 1]], int(count[i]))[0] for i in short.tolist()]
        found, rows = np.concatenate([found, np.array(whole, np.uint64)]), np.concatenate([rows, short])
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    return rows[fresh], found[fresh]


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """MinHash signatures (n, HASHES) of sorted (row, hash) pairs; rows without pairs have zeros."""
    out = np.zeros((n, HASHES), np.uint32)
    if not len(rows):
        return out
    heads = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    small = (hashes >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for j in range(HASHES):
            out[rows[heads], j] = np.minimum.reduceat(small * FACTORS[j] + SHIFTS[j], heads)
    return out


def _bands(signature: np.ndarray) -> np.ndarray:
    """One hash per band, its last five bits the band's number."""
    out = np.zeros((len(signature), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            out = mix(out * np.uint64(31) + signature[:, k::ROWS].astype(np.uint64), 11 + k)
    return out & ~np.uint64(BANDS - 1) | np.arange(BANDS, dtype=np.uint64)


def _byte(signature: np.ndarray) -> np.ndarray:
    """One evenly spread byte of each MinHash (the minimum itself is a small number)."""
    with np.errstate(over="ignore"):
        return ((signature * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


SKETCH = [T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
          T.StructField("marks", T.BinaryType()), T.StructField("bands", T.BinaryType())]


def sketches(keyed: DataFrame, words: int) -> DataFrame:
    """(id, key, n, digest, marks, bands): set size and digest, one byte per MinHash, and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            rows, found = shingles(*text_bytes(batch.column(2)), words)
            sizes = np.bincount(rows, minlength=n)
            signature = signatures(rows, found, n)
            marks, bands = _byte(signature), _bands(signature)
            heads = np.cumsum(sizes) - sizes
            parts = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
            some = sizes > 0
            with np.errstate(over="ignore"):
                for k, part in enumerate(parts):
                    if some.any():
                        part[some] = mix(np.add.reduceat(mix(found, 21 + k), heads[some]) + sizes[some].astype(np.uint64), 31 + k)
            digest = np.column_stack(parts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array([r.tobytes() for r in digest], pa.binary()),
                pa.array([r.tobytes() for r in marks], pa.binary()), pa.array([r.tobytes() for r in bands], pa.binary())],
                ["id", "key", "n", "digest", "marks", "bands"])

    return keyed.select("id", "key", "text").mapInArrow(run, T.StructType([keyed.schema["id"], *SKETCH]))


def shared_bands(reps: DataFrame) -> DataFrame:
    """(key, h): the band values that each representative shares with another one."""

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
                yield bands, np.repeat(np.asarray(batch.column(0)), BANDS)

    packed = meet(reps.select("key", "bands"), pairs, first_too=True, within=False)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed_h = batch.column(1).to_pylist()
            h = np.frombuffer(b"".join(packed_h), np.int64)
            keys = np.repeat(np.asarray(batch.column(0)), [len(x) // 8 for x in packed_h])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(h, pa.int64())], ["key", "h"])

    return packed.mapInArrow(spread, "key bigint, h bigint")


def full_sets(keyed: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """(key, hashes): the sorted shingle hashes of the named documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, found = shingles(*text_bytes(batch.column(1)), words)
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]) * 8
            out = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(found.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["key", "hashes"])

    texts = keyed.select("key", "text").join(keys, "key", "left_semi")
    return texts.mapInArrow(run, "key bigint, hashes binary").dropDuplicates(["key"])


@cache
def least_matches(percent: int) -> tuple[int, ...]:
    """For each number of batches compared, the fewest matches with which a pair stays.

    With a uniform prior, the posterior that a match is at least as likely as p after m of t matches is the chance
    of at most m successes in t + 1 trials with p. A byte also matches by accident, once in 256.
    """
    p = percent / 100 + (1 - percent / 100) / 256
    out = []
    for t in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += comb(t + 1, m) * p ** m * (1 - p) ** (t + 1 - m)
        out.append(m)
    return tuple(out)


def _stay(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of signature rows survive the length bound and all batches."""
    left = np.flatnonzero(100 * np.minimum(sizes_a, sizes_b) >= percent * np.maximum(sizes_a, sizes_b))
    matches = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(percent)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[left] += (a[left, part] == b[left, part]).sum(1)
        left = left[matches[left] >= least]
    out = np.zeros(len(a), bool)
    out[left] = True
    return out


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def survivors(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that sequential verification does not drop."""

    @F.arrow_udf(T.BooleanType())
    def stays(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        return pa.array(_stay(_marks(a), _marks(b), np.asarray(n), np.asarray(m), percent))

    small = reps.select("key", "n", "marks")
    one = small.select(F.col("key").alias("x"), F.col("n").alias("n_x"), F.col("marks").alias("marks_x"))
    two = small.select(F.col("key").alias("y"), F.col("n").alias("n_y"), F.col("marks").alias("marks_y"))
    both = pairs.join(one, "x").join(two, "y")
    return both.where(stays("marks_x", "marks_y", "n_x", "n_y")).select("x", "y")


def _alike(a, b, percent: int) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets are similar enough."""

    @F.arrow_udf(T.BooleanType())
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_alike(x.as_buffer(), y.as_buffer(), percent) for x, y in zip(a, b)], pa.bool_())

    one = sets.select(F.col("key").alias("x"), F.col("hashes").alias("a"))
    two = sets.select(F.col("key").alias("y"), F.col("hashes").alias("b"))
    return pairs.join(one, "x").join(two, "y").where(alike("a", "b")).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """(key, comp) of every linked key: the smallest key of its component.

    Labels move along links and then to their own label, until nothing changes; each round is stored.
    """
    links = stored(links.union(links.select("y", "x")).toDF("a", "b").distinct(), "links")
    labels = stored(links.groupBy(F.col("a").alias("key")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["key"]).groupBy("a").agg(F.min("comp").alias("near"))
        moved = labels.join(near, labels["key"] == near["a"]).select("key", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        goal = labels.select(F.col("key").alias("comp"), F.col("comp").alias("goal"))
        jumped = stored(moved.join(goal, "comp", "left").select("key", "old", F.least("comp", F.coalesce("goal", "comp")).alias("comp")), "labels")
        if jumped.where("old != comp").isEmpty():
            return jumped.select("key", "comp")
        labels = jumped.select("key", "comp")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("x"), F.greatest(a, b).alias("y")]


def centre_pairs(buckets: DataFrame) -> DataFrame:
    """Every member with two centres of its bucket, its smallest and its largest key: never the same one."""
    centres = buckets.groupBy("h").agg(F.min("key").alias("c1"), F.max("key").alias("c2"))
    rows = buckets.join(centres, "h").select("key", F.explode(F.array("c1", "c2")).alias("c")).where("key != c")
    return rows.select(*_ordered(F.col("key"), F.col("c"))).distinct()


def blocks(buckets: DataFrame, labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """(h, i, kind, j, side, key, comp): who meets whom in buckets that hold several components.

    Buckets of up to three members are through: with two centres all their pairs have met. A block has about BLOCK members
    or BLOCK_SHINGLES shingles on a side.
    """
    rows = buckets.join(labels, "key", "left").join(sizes.select("key", "n"), "key").select("h", "key", "n", F.coalesce("comp", "key").alias("comp"))
    counts = rows.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("weight"))
    largest = counts.groupBy("h").agg(F.sum("n").alias("all"), F.sum("weight").alias("all_weight"), F.max(F.struct("n", "comp", "weight")).alias("most"))

    def parts(n: Column, weight: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK, weight / BLOCK_SHINGLES)).cast("int")

    rest, rest_weight = F.col("all") - F.col("most.n"), F.col("all_weight") - F.col("most.weight")
    open_ = largest.where((rest > 0) & (F.col("all") > 3)).select(
        "h", F.col("most.comp").alias("main"), parts(rest, rest_weight).alias("others"), parts(F.col("most.n"), F.col("most.weight")).alias("mains"))
    placed = rows.join(open_, "h")
    inside = F.col("comp") == F.col("main")
    at = F.pmod(F.xxhash64("key"), F.when(inside, F.col("mains")).otherwise(F.col("others"))).cast("int")
    placed = placed.select("h", "key", "comp", "others", "mains", inside.alias("inside"), at.alias("at"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda i, kind, j, side: F.struct(i.alias("i"), F.lit(kind).alias("kind"), j.alias("j"), F.lit(side).alias("side"))
    mine = F.col("at")
    main = F.transform(every(F.col("others")), lambda i: place(i, "main", mine, 1))
    other = F.concat(
        F.transform(every(F.col("mains")), lambda j: place(mine, "main", j, 0)),
        F.transform(F.filter(every(F.col("others")), lambda j: j >= mine), lambda j: place(mine, "other", j, 0)),
        F.transform(F.filter(every(F.col("others")), lambda i: i <= mine), lambda i: place(i, "other", mine, 1)))
    return placed.select("h", "key", "comp", F.explode(F.when(F.col("inside"), main).otherwise(other)).alias("p")).select("h", "p.*", "key", "comp")


def block_links(met: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between components, from blocks: each pair is compared in the first band that it shares.

    Shared are the band hashes that made the buckets, so a pair meets in its first one whatever its marks say.
    Within a block a pair is skipped once links found there connect it, so a block gives at most one
    link per component that it joins.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key, comp, side, n = (np.asarray(table[c]) for c in ("key", "comp", "side", "n"))
        band = int(np.asarray(table["h"])[0].view(np.uint64) & np.uint64(BANDS - 1))
        marks = _marks(table["marks"])
        bands = np.frombuffer(b"".join(table["bands"].to_pylist()), np.uint64).reshape(-1, BANDS)
        held = [x.as_buffer() for x in table["hashes"]]
        group = np.unique(comp, return_inverse=True)[1]
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        xs, ys = [], []
        for i in a.tolist():
            to = b[group[b] != group[i]]
            to = to[_stay(np.broadcast_to(marks[i], (len(to), HASHES)), marks[to], np.broadcast_to(n[i], len(to)), n[to], percent)]
            to = to[(bands[to] == bands[i]).argmax(1) == band]
            while len(to):
                j, to = int(to[0]), to[1:]
                if _alike(held[i], held[j], percent):
                    xs.append(min(int(key[i]), int(key[j])))
                    ys.append(max(int(key[i]), int(key[j])))
                    group[group == group[j]] = group[i]
                    to = to[group[to] != group[i]]
        return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})

    rows = met.join(reps.select("key", "n", "marks", "bands"), "key").join(sets, "key")
    return rows.groupBy("h", "i", "kind", "j").applyInArrow(run, "x bigint, y bigint").distinct()


def linked(keyed: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, key, n, comp) of keyed documents; documents with an empty set have no comp."""
    drawn = stored(sketches(keyed, words), "sketches")
    classes = drawn.where("n > 0").groupBy("digest").agg(F.min(F.struct("key", "n", "marks", "bands")).alias("rep"))
    reps = stored(classes.select("digest", "rep.*"), "classes")
    buckets = stored(shared_bands(reps), "buckets")
    sets = stored(full_sets(keyed, buckets.select("key").distinct(), words), "sets")
    links = stored(verified(survivors(centre_pairs(buckets), reps, percent), sets, percent), "centre-links")
    labels = components(links)
    more = stored(block_links(blocks(buckets, labels, reps), reps, sets, percent), "block-links")
    if not more.isEmpty():
        found = [labels.select(F.col("key").alias(c), F.col("comp").alias(f"comp_{c}")) for c in ("x", "y")]
        joined = more.join(found[0], "x", "left").join(found[1], "y", "left").select(
            F.coalesce("comp_x", "x").alias("x"), F.coalesce("comp_y", "y").alias("y"))
        top = components(joined).toDF("comp", "top")
        nodes = labels.unionByName(top.select(F.col("comp").alias("key"), "comp").join(labels.select("key"), "key", "left_anti"))
        labels = stored(nodes.join(top, "comp", "left").select("key", F.coalesce("top", "comp").alias("comp")), "labels")
    named = reps.select("digest", "key").join(labels, "key", "left").select("digest", F.coalesce("comp", "key").alias("comp"))
    return drawn.select("id", "key", "n", "digest").join(named, "digest", "left").select("id", "key", "n", "comp")


def link(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_shingles``, ``component_id`` and ``kept``."""
    members = linked(row_keys(docs, id_col, text_col)[0], words, percent)
    smallest = members.where("comp is not null").groupBy("comp").agg(F.min("id").alias("least"))
    component = F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least"))
    return members.join(smallest, "comp", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each component: the smallest id, of rows with that id the smallest key; equal rows once.

    Documents with an empty set stay, equal rows once.
    """
    keyed, repeated = row_keys(docs, id_col, text_col)
    members = linked(keyed, words, percent)
    first = members.where("comp is not null").groupBy("comp").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    stay = first.select("first.key").unionByName(members.where("comp is null").select("key"))
    rows = narrow(docs, whole_row=True, id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = rows.select((hashed_key(F.col("id"), text) if repeated else F.col("id").cast("long")).alias("key"), "row")
    if repeated:
        rows = rows.groupBy("key").agg(F.first("row").alias("row"))
    return rows.join(stay.distinct(), "key", "left_semi").select("row.*")
