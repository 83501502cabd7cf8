"""Secret scans over a trigram inverted index.

Each rule's regular expression is read into a Boolean query over lower-case trigrams. The trigrams
that any rule asks for are indexed: postings are bounded sorted lists, one per trigram and block
of ids. A block's postings are intersected and united as each query says; what is left are the
candidate documents of that rule, and only they are matched against the expression. A rule
whose expression demands no trigram is matched against every document.

Everything is column functions and joins. Null texts are empty and have no spans; a null id is
kept (it shares the postings of id 0, which at worst adds a candidate); repeated rows and ids
give one result row each; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import narrow, whole_text
from tidemill.llm.spans import listed, matches, tagged

BLOCK = 4096  # ids per block: the longest possible posting list
MOST_STRINGS = 256  # alternatives that a query spells out before it stops refining


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and which part of a match must have how many characters."""

    kind: str
    pattern: str
    at_least: int = 1
    group: int | None = None


# The base rules, in the order in which kinds are listed. {n,} replaces a test of length where no match can hide another.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

# A query is True (no demand), a trigram, or ("and" | "or", frozenset of queries).


def _join(op: str, queries) -> object:
    parts = set()
    for q in queries:
        if q is True:
            if op == "or":
                return True
        elif isinstance(q, tuple) and q[0] == op:
            parts |= q[1]
        else:
            parts.add(q)
    if not parts:
        return True
    if op == "or":  # a stricter alternative adds nothing
        sets = {q: q[1] if isinstance(q, tuple) and q[0] == "and" else frozenset([q]) for q in parts}
        parts = {q for q in parts if not any(sets[o] < sets[q] for o in parts)}
    return next(iter(parts)) if len(parts) == 1 else (op, frozenset(parts))


def _demand(strings: set[str]) -> object:
    """What a text must hold if it holds one of the strings."""
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(nodes) -> tuple[set[str] | None, object]:
    """(all strings that the nodes can match, or None if there are too many; what they demand)."""
    run, asked = {""}, []

    def close():
        asked.append(_demand(run))
        run.clear()
        run.add("")

    for op, arg in nodes:
        strings, query = _node(op, arg)
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            longer = {a + b for a in run for b in strings}
            run.clear()
            run.update(longer)
        else:
            close()
            asked.append(query if strings is None else _demand(strings))
            if strings is not None:
                run.clear()
                run.update(strings)
    if any(q is not True for q in asked) or (asked and run == {""}):
        return None, _join("and", [*asked, _demand(run)])
    return (None, _demand(run)) if asked else (set(run), True)


def _node(op, arg) -> tuple[set[str] | None, object]:
    if op is K.LITERAL:
        return {chr(arg).lower()}, True
    if op is K.IN:
        chars = set()
        for kind, value in arg:
            if kind is K.LITERAL:
                chars.add(chr(value).lower())
            elif kind is K.RANGE and value[1] - value[0] < 8:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is K.SUBPATTERN:
        return _walk(arg[-1])
    if op is K.BRANCH:
        parts = [_walk(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*[s for s, _ in parts]), True
        return None, _join("or", [q if s is None else _demand(s) for s, q in parts])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        low, high, body = arg
        strings, query = _walk(body)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, True
        if low == 0:
            return None, True
        if strings is not None and low == high and len(strings) ** low <= MOST_STRINGS:
            out = {""}
            for _ in range(low):
                out = {a + b for a in out for b in strings}
            return out, True
        return None, query if strings is None else _demand(strings)
    return None, True


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of an expression: every text it matches, lower-cased, satisfies it."""
    strings, query = _walk(_parser.parse(pattern))
    return query if strings is None else _demand(strings)


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _candidates(query: object, postings: Column) -> Column:
    """The ids of a block that satisfy a query, from its map of trigram to id list."""
    if isinstance(query, str):
        return F.coalesce(F.element_at(postings, F.lit(query)), F.expr("cast(array() as array<bigint>)"))
    merge = F.array_intersect if query[0] == "and" else F.array_union
    parts = [_candidates(q, postings) for q in sorted(query[1], key=repr)]
    out = parts[0]
    for part in parts[1:]:
        out = merge(out, part)
    return out


def _pairs(keys: Column, rule: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(rule).alias("rule")))


def _long_enough(found: Column, n: int) -> Column:
    return F.filter(found, lambda s: F.length(s["part"]) >= n)


def index(docs: DataFrame, grams: set[str]) -> DataFrame:
    """(block, postings map<trigram, ids>): the inverted index of ``docs`` (key, text) for these trigrams."""
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in sorted(grams)]))
    rows = low.select("key", F.explode(held).alias("gram"))
    lists = rows.groupBy(F.floor(F.col("key") / BLOCK).alias("block"), "gram").agg(F.array_sort(F.collect_set("key")).alias("ids"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "ids"))).alias("postings"))


def _spans(rows: DataFrame, texts: DataFrame, text: Column, rules: tuple[Rule, ...]) -> DataFrame:
    """``rows`` (with a key) and ``spans``; ``texts`` has the same documents as (key, text), ``text`` reads a row's text."""
    queries = [trigram_query(r.pattern) for r in rules]
    grams = set().union(*map(trigrams, queries))
    tried = {}
    if grams:
        hits = F.concat(*[_pairs(_candidates(q, F.col("postings")), i) for i, q in enumerate(queries) if q is not True])
        pairs = index(texts, grams).select(F.explode(hits).alias("hit")).select("hit.key", "hit.rule")
        rows = rows.join(pairs.groupBy("key").agg(F.collect_set("rule").alias("rules")), "key", "left")
        tried = {i: F.coalesce(F.array_contains("rules", i), F.lit(False)) for i, q in enumerate(queries) if q is not True}
    spans = []
    for i, rule in enumerate(rules):
        got = matches(text, rule.pattern, rule.group, tried.get(i))
        if rule.at_least > 1:
            got = _long_enough(got, rule.at_least)
        spans.append(tagged(got, i, rule.kind))
    return rows.withColumn("spans", F.array_sort(F.concat(*spans)))


def _key(text: Column) -> Column:
    """What brings a document and its candidate rules together. Documents without an id go by their text, so that they do not share one key;
    should two documents share a key, each is tried with the rules of both."""
    return F.coalesce(F.col("id").cast("long"), F.xxhash64(text)).alias("key")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``spans`` array<struct<start, rank, kind, end>>, ordered, ends exclusive."""
    cut = whole_text(docs, id_col, text_col).select("id", "text", _key(F.col("text")))
    found = _spans(cut, cut.select("key", "text"), F.col("text"), rules)
    return found.select(F.col("id").alias(id_col), "spans")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mark: str = "[secret]", id_col: str = "doc_id",
           text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every stretch covered by spans replaced by the mark; ``length_col``, if there, follows the text.

    Documents without spans come back unchanged, null texts too.
    """
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    cut = narrow(docs, whole_row=True, id=id_col, text=text_col).select("row", _key(text))
    found = _spans(cut, whole_text(docs, id_col, text_col).select(_key(F.col("text")), "text"), text, rules)
    walked = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda state, s: F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), F.concat(
            state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark)).alias("out"))).otherwise(
            F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))),
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    clean = found.select("row", F.when(F.size("spans") > 0, walked).alias("clean"))
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == text_col:
            value = F.coalesce("clean", value)
        elif name == length_col:
            value = F.coalesce(F.length("clean").cast("long"), value)
        columns.append(value.alias(name))
    return clean.select(*columns)


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [_count(r.kind).alias(f"n_{r.kind}") for r in BASE]
    return scanned.select(id_col, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
