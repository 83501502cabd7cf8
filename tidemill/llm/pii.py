"""Personal data: fixed patterns, and bootstrapped contextual extraction on top.

E-mail addresses, IP addresses, payment cards and phone numbers are found by expression and check. These seed
a graph of lexical patterns and instances (the values). A value's patterns are the two words before it, and its field label, if it
has one (``account: ..``, ``"account": ".."``, ``account=..``). A pattern's
confidence is the share of its occurrences whose value is known, an unknown value's is that at
least one of its patterns is right, and some rounds of both let values vouch for new patterns. Then
identifier-like words that follow a pattern of high confidence and enough distinct values are
reported as kind ``context``. The fixed spans always stay. A single word without a label's mark is no pattern: in prose any common word
stands before known values often enough to vouch for whatever number follows it.

An identifier-like word has LEAST_DIGITS digits, or an at sign before a letter or digit. Words and labels that do not lie within the LOOK_BACK
characters before a value are too long to be a pattern.

Everything is column functions, joins and grouping; the graph is small beside the texts, which are read
once. Null texts are empty. Each input row gives one result row, also for null or repeated ids; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored, whole_text
from tidemill.llm.spans import listed, matches, tagged

# The kinds in the order in which they are listed. Possessive loops and the looks behind change no match; they
# keep long runs of digits or letters linear and off the stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# A word with a digit or an at sign; it starts after white space (or at the start). A label in front of a value. What a word has around its
# value: brackets, quotes and a label before it, quotes and marks behind it.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
LABEL = r"""(\p{L}[\p{L}\p{N}_-]*+)["']?\s*[:=]\s*["'(]?$"""
HEAD = r"""^["'(\[{<]*+(?:\p{L}[\p{L}\p{N}_-]*+["']?[:=]["'(]?)?"""
TAIL = r"""["')\]}>.,;:!?]++$"""
LEAST_DIGITS = 5        # of an identifier-like word without an at sign
ROUNDS = 2              # of patterns scoring instances and instances scoring patterns
LEAST_CONFIDENCE = 0.8  # of a pattern that may report
LEAST_INSTANCES = 5     # distinct known values of such a pattern
SMOOTHING = 1.0         # occurrences that a pattern has to outweigh
LOOK_BACK = 400         # characters before a value in which the words of its patterns lie


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), _luhn_digit), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _luhn_digit(char: Column, place: Column) -> Column:
    value = F.coalesce(F.try_to_number(char, F.lit("9")).cast("int"), F.lit(0))
    twice = value * 2
    return F.when(place % 2 == 0, value).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def base_spans(text: Column) -> Column:
    """array<struct<start, rank, kind, end>> of the fixed kinds, each kind on its own."""
    email = matches(text, EMAIL, when=F.contains(text, F.lit("@")))
    ip = F.filter(matches(text, IP), lambda s: F.rlike(s["hit"], F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$")))
    card = F.filter(matches(text, CARD, when=F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){13}"))), _is_card)
    phone = F.filter(matches(text, PHONE, when=F.contains(text, F.lit("+"))), lambda s: F.length(_digits(s["hit"])).between(10, 15))
    return F.concat(*[tagged(found, i, kind) for i, (found, kind) in enumerate(zip((email, ip, card, phone), KINDS))])


def _is_card(span: Column) -> Column:
    digits = _digits(span["hit"])
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))


def _patterns(text: Column, start: Column) -> Column:
    """The patterns of a value: its two words before, in lower case without marks around them, and its label; those that it has."""
    cut = start > LOOK_BACK
    before = F.concat(F.when(cut, F.lit("")).otherwise(F.lit(" ")),  # a word that is cut off is none
                      F.substring(text, F.greatest(start - LOOK_BACK, F.lit(0)) + 1, F.least(start, F.lit(LOOK_BACK))))
    two = F.trim(F.regexp_replace(F.lower(F.regexp_extract(before, r"\s(\S+\s+\S+)\s+$", 1)), r"[^\p{L}\p{N}]+", " "))
    label = F.lower(F.regexp_extract(before, LABEL, 1))
    return F.filter(F.array(F.when(two != "", F.concat(F.lit("words "), two)), F.when(label != "", F.concat(F.lit("label "), label))),
                    lambda p: p.isNotNull())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, base, values): the fixed spans of every text, and all values with their patterns.

    ``values`` holds structs (start, end, value, patterns, seed) of the fixed spans and of the
    identifier-like words that touch none of them; labels, quotes and marks around a value are not part of it.
    """
    text = F.col("text")
    rows = whole_text(docs, id_col, text_col).select("id", "text", F.array_sort(base_spans(text)).alias("base"))
    bare = F.transform(matches(text, TOKEN), lambda s: F.struct(
        (s["start"] + F.length(F.regexp_extract(s["hit"], HEAD, 0))).alias("start"), (s["end"] - F.length(F.regexp_extract(s["hit"], TAIL, 0))).alias("end"),
        F.regexp_replace(F.regexp_replace(s["hit"], HEAD, ""), TAIL, "").alias("hit")))
    words = F.filter(bare, lambda s: (F.length(_digits(s["hit"])) >= LEAST_DIGITS) | F.rlike(s["hit"], F.lit(r"@[\p{L}\p{N}]")))
    free = F.filter(words, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    known = F.transform("base", lambda s: F.struct(
        s["start"], s["end"], F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("value"),
        _patterns(text, s["start"]).alias("patterns"), F.lit(True).alias("seed")))
    unknown = F.transform(free, lambda s: F.struct(
        s["start"], s["end"], s["hit"].alias("value"), _patterns(text, s["start"]).alias("patterns"), F.lit(False).alias("seed")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "base", F.concat(known, unknown).alias("values"))


def graph(found: DataFrame) -> DataFrame:
    """(pattern, value, n, known): how often each pattern stands before each value, and whether the value is a fixed one."""
    seen = found.select(F.explode("values").alias("v")).select(F.explode("v.patterns").alias("pattern"), "v.value", "v.seed")
    return seen.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("seed").cast("int")).cast("double").alias("known"))


def rate(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence, instances) after the rounds of the pattern-instance graph."""
    scores = edges.withColumn("score", F.col("known"))
    for turn in range(rounds):
        rated = scores.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / (F.sum("n") + SMOOTHING)).alias("confidence"),
            F.sum((F.col("score") >= LEAST_CONFIDENCE).cast("long")).alias("instances"))
        if turn < rounds - 1:
            trusted = rated.where(F.col("instances") >= LEAST_INSTANCES)
            believed = edges.join(trusted, "pattern").groupBy("value").agg(
                (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("belief"))
            scores = edges.join(believed, "value", "left").withColumn(
                "score", F.greatest("known", F.coalesce("belief", F.lit(0.0))))
    return rated


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``spans`` array<struct<start, rank, kind, end>>, fixed and contextual."""
    found = stored(find(docs, id_col, text_col), "pii-found")
    rated = rate(stored(graph(found), "pii-edges"))
    good = rated.where((F.col("confidence") >= LEAST_CONFIDENCE) & (F.col("instances") >= LEAST_INSTANCES)).select("pattern")
    unknown = found.select("row", F.explode(F.filter("values", lambda v: ~v["seed"])).alias("v")).select(
        "row", "v.start", "v.end", F.explode("v.patterns").alias("pattern"))
    added = unknown.join(good, "pattern", "left_semi").groupBy("row").agg(F.collect_set(F.struct(
        "start", F.lit(len(KINDS)).alias("rank"), F.lit(CONTEXT).alias("kind"), "end")).alias("more"))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,end:int>>)")
    return found.join(added, "row", "left").select(
        F.col("id").alias(id_col), F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def report(extracted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the fixed kinds, the digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return extracted.select(id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
