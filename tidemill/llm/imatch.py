"""Document fingerprints by I-Match over several randomised lexicons.

Document frequencies of all terms (words in lower case) are counted exactly, over different texts, so exact copies of
a text count once and a large group of them keeps its terms. Terms within a band of
inverse document frequency form the lexicon; its size is bounded by the mean number of distinct
terms of a text over the band's lower share, whatever the corpus. Each randomised subset keeps
a fixed share of the lexicon; a document's distinct terms in a subset, in sorted order, are hashed, and
the hashes of all subsets are the fingerprint. Likeness is the share of equal subset hashes
among those that are not empty in both documents; equal fingerprints have likeness 1. A text with words but
without a lexicon term in any subset has hashes of all its distinct terms instead: it equals texts of the same terms only.

Null and empty texts have no terms: every subset is empty. The next document of ``with_next`` is the
one with the largest smaller id (after the smallest id: the largest one); a null id counts as one
below the smallest. Rows that repeat an id give one result row each and share the next document;
where the next id has several rows, its smallest text and its smallest fingerprint count. The one
document of a table is its own next. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import SLICE_CHARS, ranges, slices, stored, text_bytes, whole_text
from tidemill.llm.words import LOWER, mix, powers, row_of, split_words, word_hashes

LEAST_SHARE, MOST_SHARE = 0.002, 0.2  # the band: document frequency as a share of all documents
SUBSETS = (24, 96, 384, 1536)         # one term in so many is kept ...
EACH = 16                             # ... by so many subsets each
PENDING = 1_000_000                   # counts that a task gathers before it folds them
LEAST_ROWS, MOST_BLOCKS, RANGES = 2_000, 100_000, 200  # blocks of neighbouring ids


def _distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term hash) of the distinct terms of each row, sorted by both."""
    low = LOWER[data]
    starts, ends, first = split_words(low, offsets)
    hashes, of = word_hashes(low, starts, ends), row_of(first)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    fresh = np.ones(len(of), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return of[fresh], hashes[fresh]


def frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(term bigint, df bigint): in how many different texts each term occurs, by term hash."""

    def fold(terms: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
        keys, places = np.unique(np.concatenate(terms), return_inverse=True)
        return keys, np.bincount(places, weights=np.concatenate(counts), minlength=len(keys)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        pending = 0
        for batch in slices(batches, "text"):
            found = _distinct(*text_bytes(batch.column(0)))[1]
            terms.append(found)
            counts.append(np.ones(len(found), np.int64))
            pending += len(found)
            if pending >= PENDING:
                keys, sums = fold(terms, counts)
                terms, counts, pending = [keys], [sums], 0
                if len(keys) >= PENDING // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], ["term", "df"])
                    terms, counts = [], []
        if terms:
            keys, sums = fold(terms, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], ["term", "df"])

    rows = whole_text(docs, id_col, text_col).select("text").distinct().mapInArrow(count, "term bigint, df bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    n = whole_text(docs, id_col, text_col).select(F.xxhash64("text")).distinct().count()
    low, high = max(2, LEAST_SHARE * n), MOST_SHARE * n
    kept = stored(frequencies(docs, id_col, text_col).where((F.col("df") >= low) & (F.col("df") <= high)).select("term"), "lexicon")
    # At most (mean distinct terms of a text) / LEAST_SHARE terms, however many documents.
    return np.sort(np.array([r.term for r in kept.collect()], np.int64).view(np.uint64))


def _memberships(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, subset): the subsets of lexicon term i are subset[first[i]:first[i + 1]]."""
    inside = np.column_stack([mix(terms, j + 1) % np.uint64(SUBSETS[j // EACH]) == 0 for j in range(len(SUBSETS) * EACH)])
    return np.concatenate([[0], np.cumsum(inside.sum(1))]).astype(np.int64), np.nonzero(inside)[1]


def _fingerprints(terms: np.ndarray, members: tuple[np.ndarray, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of subset hashes (uint32, 0: no terms) per text."""
    n, k = len(offsets) - 1, len(SUBSETS) * EACH
    out = np.zeros(n * k, np.uint32)
    of, hashes = _distinct(data, offsets)
    at = np.searchsorted(terms, hashes)
    inside = np.flatnonzero(at < len(terms))
    inside = inside[terms[at[inside]] == hashes[inside]]
    row, at = of[inside], at[inside]
    first, subset = members
    times = first[at + 1] - first[at]
    cell = np.repeat(row * k, times) + subset[ranges(first[at], times)]
    if len(cell):
        order = np.argsort(cell, kind="stable")  # terms stay sorted within a cell
        heads, sums = _sums(cell[order], np.repeat(mix(terms[at], 99), times)[order])
        out[cell[order][heads]] = _nonzero(mix(sums))
    out = out.reshape(n, k)
    bare = ~out.any(1)[of]  # terms of texts that no subset knows
    if bare.any():
        heads, sums = _sums(of[bare], mix(hashes[bare], 99))
        with np.errstate(over="ignore"):
            out[of[bare][heads]] = _nonzero(mix(mix(sums, 100)[:, None] + np.arange(k, dtype=np.uint64)))
    return out


def _sums(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(head, hash) of each run of equal groups, over its values in order."""
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    place = np.arange(len(groups)) - np.repeat(heads, np.diff(np.append(heads, len(groups))))
    with np.errstate(over="ignore"):
        return heads, np.add.reduceat(values * powers(int(place.max()) + 1)[place], heads)


def _nonzero(hashes: np.ndarray) -> np.ndarray:
    return np.maximum(hashes >> np.uint64(32), np.uint64(1)).astype(np.uint32)


def fingerprint(text: Column, terms: np.ndarray) -> Column:
    """The fingerprint of a text as hex, eight digits per subset. The lexicon goes with the function (size: see ``lexicon``)."""

    @F.arrow_udf(T.StringType())
    def of(texts: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        cuts = [0, *(np.flatnonzero(np.diff(offsets[1:] // SLICE_CHARS)) + 1).tolist(), len(texts)]
        out: list[str] = []
        members = _memberships(terms)
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                prints = _fingerprints(terms, members, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                out += [row.tobytes().hex() for row in prints.astype(">u4")]
        return pa.array(out, pa.string())

    return of(F.coalesce(text.cast("string"), F.lit("")))


@F.arrow_udf(T.DoubleType())
def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    """Share of equal subset hashes among those not empty in both; 1 for equal fingerprints."""
    x, y = (np.frombuffer(text_bytes(col)[0], "S8").reshape(len(col), -1) for col in (a, b))
    none = b"0" * 8
    some = ((x != none) | (y != none)).sum(1)
    same = ((x == y) & (x != none)).sum(1)
    return pa.array(np.where((x == y).all(1), 1.0, same / np.maximum(some, 1)))


def _blocks(ids: DataFrame, rows: int):
    """A function from ids to ascending block numbers: quantile ranges, each cut evenly by value."""
    ranges_ = min(RANGES, max(1, rows // LEAST_ROWS))
    cuts = np.unique(np.array(ids.approxQuantile("id", [i / ranges_ for i in range(ranges_ + 1)], 0.1 / ranges_), np.float64))
    cuts = np.clip(cuts, -2.0 ** 62, 2.0 ** 62).astype(np.int64)
    parts = min(MOST_BLOCKS, max(1, rows // LEAST_ROWS)) // ranges_ + 1
    widths = np.maximum(np.diff(np.append(cuts, cuts[-1:] + 1)) // parts + 1, 1)

    @F.arrow_udf(T.LongType())
    def block(keys: pa.Array) -> pa.Array:
        keys = np.asarray(keys)
        at = np.maximum(np.searchsorted(cuts, keys, "right") - 1, 0)
        inside = np.clip(keys // widths[at] - cuts[at] // widths[at], 0, 2 ** 31 - 1)
        return pa.array((at.astype(np.int64) << 32) + inside)

    return block


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 3) -> DataFrame:
    """(key, id, text, next_key, edited): every document, and its text with the last 1/share replaced by the next document's start.

    The texts are shuffled once, to blocks of neighbouring ids, and walked in descending order; each block
    also gets the first document of the block that follows. There are at most about MOST_BLOCKS blocks.
    """
    cut = whole_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    ids = cut.select("id")
    sizes = ids.agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).first()
    missing = 0 if sizes.low is None else max(sizes.low - 1, -2 ** 63)
    block = _blocks(ids.na.fill(missing), sizes.n) if sizes.n else (lambda key: key)
    key = F.coalesce("id", F.lit(missing).cast("long"))
    tops = ids.select(key.alias("key")).select("key", block(F.col("key")).alias("block")).groupBy("block").agg(F.max("key").alias("key"))
    ascending = Window.orderBy("block")  # one row per block
    whole = ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copies = tops.select("key", F.coalesce(F.lead("block").over(ascending), F.min("block").over(whole)).alias("also"))
    keyed = cut.select(key.alias("key"), "id", "text").select("key", "id", "text", block(F.col("key")).alias("block"))
    # Broadcast: one row per block, so at most about MOST_BLOCKS + RANGES rows of two numbers.
    places = keyed.join(F.broadcast(copies), "key", "left").select(
        "key", "id", "text", F.explode(F.when(F.col("also").isNull(), F.array(_place(F.col("block"), 0))).otherwise(
            F.array(_place(F.col("block"), 0), _place(F.col("also"), 1)))).alias("p"))
    rows = places.select("p.block", "p.extra", "key", "id", "text").repartition("block").sortWithinPartitions(
        "block", "extra", F.desc("key"), "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # rows of one (block, key) that still lack the next text
        out: list[tuple] = []
        size = 0
        place = None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[:3] != place:
                    if place is not None and row[0] == place[0]:
                        for _, _, k, i, text in waiting:
                            n = len(text) // share
                            out.append((k, i, text, row[2], text[:len(text) - n] + row[4][:n]))
                            size += len(text)
                    waiting, place = [], row[:3]
                if row[1] == 0:
                    waiting.append(row)
                if size >= SLICE_CHARS:
                    yield pa.RecordBatch.from_pylist([dict(zip(NEXT.names, o)) for o in out], NEXT)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(NEXT.names, o)) for o in out], NEXT)

    return rows.mapInArrow(walk, "key bigint, id bigint, text string, next_key bigint, edited string")


NEXT = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("text", pa.string()), ("next_key", pa.int64()), ("edited", pa.string())])


def _place(block: Column, extra: int) -> Column:
    return F.struct(block.alias("block"), F.lit(extra).alias("extra"))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next document's."""
    terms = lexicon(docs, id_col, text_col)
    rows = with_next(docs, id_col, text_col)
    prints = stored(rows.select(
        "key", "id", "next_key", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), terms).alias("fingerprint"), fingerprint(F.col("edited"), terms).alias("edited_fingerprint")), "fingerprints")
    following = prints.groupBy(F.col("key").alias("next_key")).agg(F.min("fingerprint").alias("next_fingerprint"))
    return prints.join(following, "next_key").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
