"""Benchmark decontamination by templates.

Texts become sequences of canonical tokens: numbers, names (capitalised words inside a sentence) and units
after numbers turn into typed placeholders, other words are lower-cased and stripped of marks.
Every window of WINDOW canonical tokens of a benchmark item (an item shorter than that is one window) is
hashed; document windows with the same hash are joined to them, compared token by token, and their slots
checked: one value of the item must always stand for one value of the document, and names one to one.
So a question with other numbers or names is caught as well as a copy. Windows with
few literal words need equal slots.

Texts are also read a second way (``loose``): a number is cut from a unit written to it, runs of number words and of
capitalised words are one placeholder, names may hold inner capitals or an apostrophe, and scripts without spaces are
cut into characters. Windows of either reading of an item meet windows of either reading of a document.

A bitmap of the benchmark's window hashes (a fixed 2 MB, whatever the benchmark) lets tasks drop nearly all
document windows before the shuffle; the join decides. Null and empty texts have no windows. Items of fewer than
LEAST_TOKENS tokens never match. Null ids are results like others; repeated rows give one result per
distinct (document, item). Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import narrow, slices, stored, text_bytes, whole_text
from tidemill.llm.words import LOWER, prefix_hash, split_words, stretch_hash, window_hashes, word_hashes

WINDOW = 13
LEAST_TOKENS = 5
LEAST_LITERAL = 0.5    # share of literal tokens below which slots must be equal
BITS = 24              # the bitmap has 2**BITS places
CACHE_WORDS = 150_000  # classes of words that are not plain that a worker remembers; only speed depends on it

LITERAL, NUMBER, NAME, UNIT, NOTHING = range(5)
MARKS = {NUMBER: "<number>", NAME: "<name>", UNIT: "<unit>"}
# Words that count as numbers, and as units after a number.
NUMBER_WORDS = frozenset("one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
UNITS = frozenset(
    "m km cm mm mi mile miles metre metres meter meters kilometre kilometres kilometer kilometers foot feet ft inch inches yard yards "
    "g kg mg lb lbs gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees kmh mph kph volt volts watt watts joule joules newton newtons".split())

# For the second reading only.
MORE_NUMBER_WORDS = NUMBER_WORDS | frozenset(
    "thirteen fourteen fifteen sixteen seventeen eighteen nineteen sixty seventy eighty ninety billion".split())
MORE_UNITS = UNITS | frozenset("am pm w kw kwh kb mb gb tb hz khz mhz ghz cm2 m2 m3".split())

_AROUND = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
_NUMBER = regex.compile(r"\d[\d.,:/]*(?:st|nd|rd|th|%)?")
_NAME = regex.compile(r"\p{Lu}\p{Ll}*(?:['’-]?\p{Lu}\p{Ll}+)+(?:['’]s)?|\p{Lu}['’]\p{Lu}\p{Ll}+(?:['’]s)?")
_GLUED = regex.compile(r"([0-9][0-9.,:/]*)(\p{L}[\p{L}\p{N}/]*)")
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_HAS_UNSPACED = regex.compile(f"[{_UNSPACED}]")
_CHARACTERS = regex.compile(rf"[0-9][0-9.,:/]*|[{_UNSPACED}]\p{{M}}*|[^0-9{_UNSPACED}]+")
_ENDS = regex.compile(r"[.!?:;][^\p{L}\p{N}]*$")


def _classify(word: bytes) -> tuple[int, bytes]:
    """(flags, canonical word): kind (three bits), capitalised, ends a sentence; for the second reading: a name, a number word, a unit, to be cut."""
    raw = word.decode("utf-8", "replace")
    core = _AROUND.sub("", raw)
    low = core.lower()
    if not core:
        kind = NOTHING
    elif _NUMBER.fullmatch(core) or low in NUMBER_WORDS:
        kind = NUMBER
    elif low in UNITS:
        kind = UNIT
    else:
        kind = LITERAL
    capital = len(core) > 1 and core[0].isupper() and core[1:].islower()
    name = capital or core[:1].isupper() and bool(_NAME.fullmatch(core))
    number = low in MORE_NUMBER_WORDS or "-" in low and all(part in MORE_NUMBER_WORDS for part in low.split("-"))
    unit = low in MORE_UNITS or "/" in low and all(part in MORE_UNITS for part in low.split("/"))
    cut = not core.isascii() and len(core) > 1 and bool(_HAS_UNSPACED.search(core)) or core[:1].isdigit() and _glued(core) is not None
    return cut << 8 | unit << 7 | number << 6 | name << 5 | bool(_ENDS.search(raw)) << 4 | capital << 3 | kind, low.encode()


def _coded(found: Sequence[tuple[int, bytes]]) -> np.ndarray:
    """Classes of words: the flags, and above them the hash of the canonical word."""
    ends = np.cumsum([len(low) for _, low in found], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    hashes = word_hashes(np.frombuffer(b"".join(low for _, low in found), np.uint8), starts, ends) if len(found) else np.zeros(0, np.uint64)
    return hashes >> np.uint64(9) << np.uint64(9) | np.array([flags for flags, _ in found], np.uint64)


def _glued(core: str):
    """A match of a number and the unit written to it, or None. Ordinals are numbers already."""
    found = _GLUED.fullmatch(core)
    return found if found and all(part in MORE_UNITS for part in found[2].lower().split("/")) else None


def _pieces(word: bytes) -> list[tuple[int, int, int]]:
    """(start, end, class) of the parts of a word that is to be cut; only the last part may end a sentence."""
    raw = word.decode("utf-8", "replace")
    core = _AROUND.sub("", raw)
    at = raw.index(core)
    found = _glued(core)
    cuts = [found.span(1), found.span(2)] if found else [m.span() for m in _CHARACTERS.finditer(core)]
    spans = [tuple(len(raw[:at + x].encode()) for x in cut) for cut in cuts]
    codes = (_coded([_classify(word[a:b]) for a, b in spans]) & ~np.uint64(1 << 8)).tolist()
    out = [(a, b, code) for (a, b), code in zip(spans, codes) if code & 7 != NOTHING]
    if _ENDS.search(raw):
        out[-1] = (*out[-1][:2], out[-1][2] | 1 << 4)
    return out


def _hash_set(words: frozenset) -> np.ndarray:
    return np.sort(_coded([(0, w.encode()) for w in sorted(words)]))


_NUMBER_CODES, _UNIT_CODES = _hash_set(NUMBER_WORDS), _hash_set(UNITS)
_MORE_NUMBER_CODES, _MORE_UNIT_CODES = _hash_set(MORE_NUMBER_WORDS), _hash_set(MORE_UNITS)
# Bytes: marks, small letters, capitals, digits, bytes beyond ASCII.
_MARK, _SMALL, _CAPITAL, _DIGIT, _BEYOND = range(5)
_BYTES = np.full(256, _MARK, np.int8)
_BYTES[97:123], _BYTES[65:91], _BYTES[48:58], _BYTES[128:] = _SMALL, _CAPITAL, _DIGIT, _BEYOND
_STOPS = np.zeros(256, bool)
_STOPS[[ord(c) for c in ".!?:;"]] = True


def _within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def _plain_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, known): the classes of plain words, without a call per word; ``known`` says which words are plain.

    A plain word has marks at its ends only and else letters: small ones of ASCII and of the second half of Latin-1, after at
    most one capital, or capitals alone. Others are left to ``_classify``, which says the same of plain ones.
    """
    kind = _BYTES[data]
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x9F) & (data[1:] < 0xC0) & (data[1:] != 0xB7))
    kind[second], kind[second + 1] = _SMALL, _SMALL
    solid = np.append(np.flatnonzero(kind != _MARK), len(data))
    begin = solid[np.searchsorted(solid, starts)]
    blank = begin >= ends
    begin = np.where(blank, starts, begin)
    end = np.where(blank, ends, solid[np.searchsorted(solid, ends) - 1] + 1)
    length = end - begin
    capitals = _within(kind == _CAPITAL, begin, end)
    odd = _within((kind == _DIGIT) | (kind == _BEYOND), starts, ends) + _within(kind == _MARK, begin, end)
    first = kind[begin] == _CAPITAL
    known = blank & (_within(kind == _BEYOND, starts, ends) == 0) | ~blank & (odd == 0) & (
        (capitals == 0) | first & (capitals == 1) | (capitals == length))
    low = stretch_hash(prefix_hash(LOWER[data]), begin, end) >> np.uint64(9) << np.uint64(9)
    capital = first & (capitals == 1) & (length > 1)
    stop = _within(_STOPS[data], end, ends) > 0
    what = np.where(blank, NOTHING, np.where(np.isin(low, _NUMBER_CODES), NUMBER, np.where(np.isin(low, _UNIT_CODES), UNIT, LITERAL)))
    flags = (what + (capital * 8 + stop * 16 + capital * 32) + np.isin(low, _MORE_NUMBER_CODES) * 64 + np.isin(low, _MORE_UNIT_CODES) * 128)
    return low | flags.astype(np.uint64), known


_CACHE: dict[int, int] = {}


def _words(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, row, classes) of all words that are more than marks."""
    starts, ends, first = split_words(data, offsets)
    if not len(starts):
        return starts, ends, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    classes, known = _plain_classes(data, starts, ends)
    others = np.flatnonzero(~known)
    if len(others):
        hashes = word_hashes(data, starts[others], ends[others])
        different, where, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(_CACHE) > CACHE_WORDS:
            _CACHE.clear()
        keys = different.tolist()
        new = [(h, others[i]) for h, i in zip(keys, where.tolist()) if h not in _CACHE]
        codes = _coded([_classify(data[starts[i]:ends[i]].tobytes()) for _, i in new]).tolist()
        _CACHE.update((h, code) for (h, _), code in zip(new, codes))
        classes[others] = np.array([_CACHE[h] for h in keys], np.uint64)[place]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    real = classes & np.uint64(7) != NOTHING
    return starts[real], ends[real], row[real], classes[real]


def _follows(row: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word has one before it in its row, and whether that one does not end a sentence."""
    same, open_ = np.zeros(len(row), bool), np.zeros(len(row), bool)
    same[1:] = row[1:] == row[:-1]
    open_[1:] = classes[:-1] & np.uint64(16) == 0
    return same, open_


def _strict(row: np.ndarray, classes: np.ndarray) -> np.ndarray:
    kind = (classes & np.uint64(7)).astype(np.int8)
    same, open_ = _follows(row, classes)
    before = np.zeros(len(row), np.int8)
    before[1:] = kind[:-1]
    kinds = np.where(kind == NUMBER, NUMBER, LITERAL)
    kinds[(kind == LITERAL) & (classes & np.uint64(8) > 0) & same & open_] = NAME
    kinds[(kind == UNIT) & same & (before == NUMBER)] = UNIT
    return kinds


def _codes(kinds: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return np.where(kinds == LITERAL, classes >> np.uint64(9), kinds.astype(np.uint64))


def canonical(data: np.ndarray, offsets: np.ndarray, words=None):
    """(starts, ends, first, kinds, codes) of the canonical tokens of each row."""
    starts, ends, row, classes = words or _words(data, offsets)
    kinds = _strict(row, classes)
    return starts, ends, np.searchsorted(row, np.arange(len(offsets))), kinds, _codes(kinds, classes)


def loose(data: np.ndarray, offsets: np.ndarray, words, heads: bool = False):
    """As ``canonical``, in the second reading, and which tokens differ from the first. With ``heads`` a row's first word may be a name."""
    starts, ends, row, classes = words
    other = np.zeros(len(row), bool)
    cut = np.flatnonzero(classes & np.uint64(256))
    if len(cut):
        parts = [_pieces(data[a:b].tobytes()) for a, b in zip(starts[cut].tolist(), ends[cut].tolist())]
        many = np.ones(len(row), np.int64)
        many[cut] = [len(p) for p in parts]
        at = np.repeat(np.arange(len(row)), many)
        inner = np.repeat(classes & np.uint64(256) > 0, many)
        base = starts[at[inner]]
        starts, ends, row, classes, other = starts[at], ends[at], row[at], classes[at], inner
        flat = [x for p in parts for x in p]
        starts[inner], ends[inner] = base + np.array([x[0] for x in flat]), base + np.array([x[1] for x in flat])
        classes[inner] = np.array([x[2] for x in flat], np.uint64)
    plain = _strict(row, classes)
    same, open_ = _follows(row, classes)
    spelled = classes & np.uint64(64) > 0
    kinds = np.where(spelled, NUMBER, plain)
    before = np.zeros(len(row), np.int8)
    before[1:] = kinds[:-1]
    kinds[(classes & np.uint64(128) > 0) & same & (before == NUMBER)] = UNIT
    kinds[(kinds == LITERAL) & (classes & np.uint64(32) > 0) & (same & open_ | ~same & heads)] = NAME
    before[1:] = kinds[:-1]
    near = np.zeros(len(row), bool)
    near[1:] = data[ends[:-1] - 1] != ord(",")
    joins = same & open_ & near & (kinds == before) & ((kinds == NAME) | (kinds == NUMBER) & spelled)
    other = other | (kinds != plain) | joins
    at = np.flatnonzero(~joins)
    if len(at):
        other = np.logical_or.reduceat(other, at)
        ends = ends[np.append(at[1:], len(row)) - 1]
    starts, row, kinds, classes = starts[at], row[at], kinds[at], classes[at]
    return (starts, ends, np.searchsorted(row, np.arange(len(offsets))), kinds, _codes(kinds, classes)), other


SCHEMA = [T.StructField("size", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("hash", T.LongType()),
          T.StructField("template", T.StringType()), T.StructField("slots", T.ArrayType(T.StringType())),
          T.StructField("n_windows", T.IntegerType()), T.StructField("reading", T.IntegerType())]


def _emit(ids: pa.Array, data, tokens, chosen, reading: int = 0) -> pa.RecordBatch:
    """Rows for the chosen windows: lists of (row, first token, size, hash, windows of the row)."""
    starts, ends, first, kinds, _ = tokens
    cols: list[list] = [[], [], [], [], [], [], []]
    rows = []
    for row, token, size, code, many in chosen:
        template, slots = [], []
        for k in range(token, token + size):
            core = _AROUND.sub("", data[starts[k]:ends[k]].tobytes().decode("utf-8", "replace")).lower()
            kind = int(kinds[k])
            if kind == LITERAL:
                template.append(core)
            else:
                template.append(MARKS[kind])
                slots.append(f"{MARKS[kind]}{core}")
        rows.append(row)
        for col, value in zip(cols, (size, token - int(first[row]), code, " ".join(template), slots, many, reading)):
            col.append(value)
    fields = [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32()))]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), *fields], ["id", *[f.name for f in SCHEMA]])


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All windows of all items: (id, size, at, hash, template, slots, n_windows, reading); the second reading where it differs."""
    cut = whole_text(benchmark, id_col, text_col)

    def every(tokens, rows) -> list:
        first, codes = tokens[2], tokens[4]
        chosen = []
        for row in rows:
            n = int(first[row + 1] - first[row])
            size = min(n, WINDOW)
            if n >= LEAST_TOKENS:
                hashes = window_hashes(codes[first[row]:first[row + 1]], size).view(np.int64).tolist()
                chosen += [(row, int(first[row]) + k, size, h, len(hashes)) for k, h in enumerate(hashes)]
        return chosen

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            words = _words(data, offsets)
            tokens = canonical(data, offsets, words)
            first = tokens[2]
            chosen = every(tokens, range(batch.num_rows))
            yield _emit(batch.column(0), data, tokens, chosen)
            # Inside a document the first word no longer starts a text: if capitalised it may pass for a name there.
            starts, ends, first, kinds, codes = tokens
            heads = first[:-1][np.diff(first) > 0]
            named = [h for h in heads.tolist() if kinds[h] == LITERAL and _classify(data[starts[h]:ends[h]].tobytes())[0] & 8]
            kinds, codes = kinds.copy(), codes.copy()
            kinds[named], codes[named] = NAME, np.uint64(NAME)
            again = set(named)
            more = [(r, t, size, int(window_hashes(codes[t:t + size], size).view(np.int64)[0]), many)
                    for r, t, size, _, many in chosen if t in again and t == first[r]]
            if more:
                yield _emit(batch.column(0), data, (starts, ends, first, kinds, codes), more)
            for heads in (False, True):
                tokens, other = loose(data, offsets, words, heads)
                first = tokens[2]
                found = every(tokens, [r for r in range(batch.num_rows) if other[first[r]:first[r + 1]].any()])
                if heads:
                    found = [c for c in found if c[1] == first[c[0]]]
                if found:
                    yield _emit(batch.column(0), data, tokens, found, 1)

    return cut.mapInArrow(run, T.StructType([cut.schema["id"], *SCHEMA]))


def document_windows(docs: DataFrame, sizes: list[int], bitmap: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document windows that the bitmap lets through, as in ``item_windows``."""
    cut = whole_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2**BITS bits at any size of the benchmark

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shared.value, np.uint8)
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(1))
            words = _words(data, offsets)
            for tokens, other in ((canonical(data, offsets, words), None), loose(data, offsets, words)):
                first, codes = tokens[2], tokens[4]
                so_far = None if other is None else np.concatenate([[0], np.cumsum(other)])
                chosen = []
                for size in sizes:
                    hashes = window_hashes(codes, size)
                    place = hashes >> np.uint64(64 - BITS)
                    maybe = np.flatnonzero(marked[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    if other is not None:  # windows without a different token are those of the first reading
                        maybe = maybe[so_far[maybe + size] > so_far[maybe]]
                    row = np.searchsorted(first, maybe, "right") - 1
                    inside = maybe + size <= first[row + 1]
                    chosen += [(r, t, size, h, 0) for r, t, h in zip(
                        row[inside].tolist(), maybe[inside].tolist(), hashes[maybe[inside]].view(np.int64).tolist())]
                if chosen:
                    yield _emit(batch.column(0), data, tokens, chosen)

    return cut.mapInArrow(run, T.StructType([cut.schema["id"], *SCHEMA]))


def consistent(item: Column, doc: Column) -> Column:
    """Whether each slot value of the item always stands for one value of the document, and names also the other way."""
    pairs = F.arrays_zip(item.alias("a"), doc.alias("b"))
    names = F.filter(pairs, lambda p: F.startswith(p["a"], F.lit(MARKS[NAME])))
    return (F.size(F.array_distinct(pairs)) == F.size(F.array_distinct(item))) & (
        F.size(F.array_distinct(names)) == F.size(F.array_distinct(F.transform(names, lambda p: p["b"]))))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per (document, item) that share a consistent window:

    ``n_windows`` distinct windows of the item found, their ``share`` of the item's windows (in the reading of the item
    with the larger share), and ``exact``: whether all found windows have the item's own numbers, names and units.
    """
    items = item_windows(benchmark, item_col, item_text_col)
    # The driver gets at most 2**BITS bits, in pieces of 32768, and WINDOW sizes, whatever the benchmark.
    place = F.shiftrightunsigned("hash", 64 - BITS) + 1
    pieces = items.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"), F.collect_set("size").alias("sizes")).collect()
    bitmap = bytearray(1 << (BITS - 3))
    for r in pieces:
        bitmap[(r.piece - 1) * 4096:r.piece * 4096] = r.bits
    bitmap = bytes(bitmap)
    sizes = sorted({size for r in pieces for size in r.sizes})
    ours = stored(document_windows(docs, sizes, bitmap, id_col, text_col), "windows").select(
        F.col("id").alias("doc"), "size", "hash", "template", F.col("slots").alias("doc_slots"))
    theirs = items.select(F.col("id").alias("item"), "size", "at", "hash", "template", F.col("slots").alias("item_slots"), "n_windows", "reading")
    equal = F.col("doc_slots") == F.col("item_slots")
    literal = 1 - F.size("item_slots") / F.col("size")
    hits = ours.join(theirs, ["size", "hash", "template"]).where(
        equal | ((literal >= LEAST_LITERAL) & consistent(F.col("item_slots"), F.col("doc_slots"))))
    once = hits.groupBy("doc", "item", "reading", "at").agg(F.max(equal.cast("int")).alias("same"), F.first("n_windows").alias("n_windows"))
    read = once.groupBy("doc", "item", "reading").agg(
        F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) / F.max("n_windows")).alias("share"), F.min("same").alias("same"))
    best = F.max(F.struct("share", "n"))
    return read.groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_col)).agg(
        best["n"].alias("n_windows"), best["share"].alias("share"), (F.min("same") == 1).alias("exact"))



def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that share no consistent window with any item. A text counts wherever it stands, so ids do not matter."""
    rows = narrow(docs, whole_row=True, text=text_col)
    keyed = rows.select(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("key"), "text", "row")
    bad = leaks(keyed.select("key", "text"), benchmark, "key", "text", item_col, item_text_col).select("key").distinct()
    return keyed.select("key", "row").join(bad, "key", "left_anti").select("row.*")
