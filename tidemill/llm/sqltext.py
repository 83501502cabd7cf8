"""SQL twins of the queries that SQL can express, built from the same fixed patterns."""

from __future__ import annotations

from tidemill.llm.secret_scan import BASE, MORE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(i: int, kind: str, pattern: str, test: str, group: int = 0) -> tuple[str, str]:
    """(columns of one kind's matches, list of its spans as structs), given a test over hit h and part q."""
    p = _quoted(pattern)
    columns = (f"string_split_regex(text, {p}) AS g{i}, regexp_extract_all(text, {p}) AS h{i}, "
               f"regexp_extract_all(text, {p}, {group}) AS q{i}")
    start = (f"list_sum(list_transform(g{i}[1:k], lambda x: length(x))) + "
             f"coalesce(list_sum(list_transform(h{i}[1:k - 1], lambda x: length(x))), 0)")
    spans = (f"list_transform(list_filter(range(1, len(h{i}) + 1), lambda k: {test.format(h=f'h{i}[k]', q=f'q{i}[k]')}), "
             f"lambda k: {{'s': CAST({start} AS BIGINT), 'r': {i}, 'k': '{kind}', 'e': CAST({start} + length(h{i}[k]) AS BIGINT)}})")
    return columns, spans


def _text(spans: str) -> str:
    return f"coalesce(array_to_string(list_transform(list_sort({spans}), lambda x: x.k || ':' || x.s || ':' || x.e), ','), '')"


def _either_case(pattern: str, words: str) -> str:
    """Letters of the key words as two-letter classes: ASCII only, unlike a case-insensitive flag there."""
    return pattern.replace(f"(?i:{words})", "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words))


def _secrets() -> str:
    columns, lists = [], []
    for i, rule in enumerate(BASE + MORE):
        pattern = _either_case(rule.pattern, "password|passwd|secret|token|api_?key")
        test = f"length({{q}}) >= {rule.at_least}" if rule.group else "true"
        c, s = _spans(i, rule.kind, pattern, test, rule.group or 0)
        columns.append(c)
        lists.append(f"{s} AS s{i}")
    base = ", ".join(f"s{i}" for i in range(len(BASE)))
    every = ", ".join(f"s{i}" for i in range(len(BASE + MORE)))
    counts = ", ".join(f"CAST(len(s{i}) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, {', '.join(columns)} FROM t),
s AS (SELECT doc_id, {', '.join(lists)} FROM m)
SELECT doc_id, {counts}, sha256({_text(f"flatten([{base}])")}) AS base_sha256, {_text(f"flatten([{every}])")} AS spans
FROM s"""


OP1 = _secrets()

_WORDS = r"""
t AS (SELECT doc_id, list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t)"""

OP4 = f"""
WITH {_WORDS.format(text="coalesce(text, '')")},
wins AS (SELECT doc_id, i, string_agg(word, ' ') OVER w AS win, COUNT(*) OVER w AS n FROM words
 WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
least AS (SELECT win, MIN(doc_id) AS m FROM wins WHERE n = 13 GROUP BY 1),
bad AS (SELECT doc_id, i FROM wins JOIN least USING (win) WHERE n = 13 AND m < doc_id),
marked AS (SELECT w.doc_id, w.i, w.word, MAX(CASE WHEN b.i IS NULL THEN 0 ELSE 1 END) OVER
 (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM words w LEFT JOIN bad b ON w.doc_id = b.doc_id AND w.i = b.i),
per AS (SELECT doc_id, SUM(gone) AS gone, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY i) AS kept FROM marked GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN per USING (doc_id)"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = f"translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}')"

OP9 = f"""
WITH RECURSIVE {_WORDS.format(text=_LOW)},
pairs AS (SELECT doc_id, word || ' ' || LEAD(word) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM words),
sets AS (SELECT DISTINCT doc_id, s FROM pairs WHERE s IS NOT NULL UNION SELECT doc_id, ws[1] FROM t WHERE len(ws) = 1),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM t UNION SELECT r.a, k.b FROM reach r JOIN sides k ON r.b = k.a),
least AS (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY 1)
SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, t.doc_id = component_id AS kept
FROM t JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""



def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of one-byte characters."""
    bit = "lambda x, i: xor(x >> 1, (x & 1) * 3988292384)"
    byte = f"lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {bit}, xor(c, b))"
    return (f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT)), {byte}, "
            "CAST(4294967295 AS BIGINT)), 4294967295)")


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """CTEs {name}0 .. {name}N of a tree's nodes (grp, pos, node, n) from {name}0; above a single node nothing changes."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
  SELECT grp, pos // 16 AS pos, CASE WHEN max(n) = 1 THEN min(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node,
    CAST((max(n) + 15) // 16 AS BIGINT) AS n
  FROM {name}{k} GROUP BY grp, pos // 16)""")
    return ",\n".join(out)


def _climb(leaf: str, name: str, levels: int, keep: str, grp: str) -> str:
    """CTEs that take rows (.., pos, proof, fold) of ``leaf`` up a tree: siblings join the proof, the fold is hashed with them."""
    out = []
    for k in range(levels):
        prev = leaf if k == 0 else f"{leaf}_{name}{k}"
        run = f"(SELECT grp, pos // 16 AS up, max(n) AS n, list(node ORDER BY pos) AS run FROM {name}{k} GROUP BY grp, pos // 16)"
        left = "array_to_string(r.run[1:l.pos % 16], '')"
        right = "array_to_string(r.run[l.pos % 16 + 2:], '')"
        out.append(f"""{leaf}_{name}{k + 1} AS (
  SELECT {keep}, l.pos // 16 AS pos, CASE WHEN r.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
    CASE WHEN r.n = 1 THEN fold ELSE sha256({left} || fold || {right}) END AS fold
  FROM {prev} l JOIN {run} r ON r.grp IS NOT DISTINCT FROM {grp} AND r.up = l.pos // 16)""")
    return ",\n".join(out)


# Sixteen to the eighth rows of a source, and as many sources, are as far as these levels reach.
OP11 = f"""
WITH d AS (
  SELECT doc_id, source AS grp, {_leaf('text')} AS leaf,
    CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
      ELSE {_leaf('text')} END AS claim
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
  FROM d),
t0 AS (SELECT grp, pos, leaf AS node, n FROM p),
{_tree('t', 8)},
g0 AS (
  SELECT 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, node, count(*) OVER () AS n, grp AS source FROM t8),
{_tree('g', 8)},
w AS (SELECT doc_id, grp, leaf, pos, '' AS proof, claim AS fold FROM p),
{_climb('w', 't', 8, 'doc_id, l.grp, leaf', 'l.grp')},
v AS (
  SELECT doc_id, leaf, g0.node AS subroot, g0.pos AS pos, proof, fold
  FROM w_t8 JOIN g0 ON g0.source IS NOT DISTINCT FROM w_t8.grp),
{_climb('v', 'g', 8, 'doc_id, leaf, subroot', '0')}
SELECT doc_id, leaf, subroot, (SELECT node FROM g8) AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
  fold = (SELECT node FROM g8) AS verified
FROM v_g8
"""


# Conversations are solved from the end: v0 .. v3 hold, for the state start, system, user, assistant before a row, the best rest as one
# text: ten digits of cost, the edits, a space, and the repaired lines. The least text has the least cost, then the least edits.
_BODY = "regexp_replace({t}, '[\\x20\\x09-\\x0D]+$', '')"


def _put(cost: str, letter: str, line: str, rest: str) -> str:
    """A rest with one edit before it."""
    sp = f"strpos(substr({rest}, 11), ' ')"
    return (f"lpad(CAST(CAST(substr({rest}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{letter}' || substr({rest}, 11, {sp}) || "
            f"{line} || substr({rest}, 11 + {sp})")


def _states() -> tuple[str, str]:
    free, name = [2, 2, 3, 2], ["", "", "user", "assistant"]
    kept = [("s", 0, 1), ("u", 0, 2), ("u", 1, 2), ("a", 2, 3), ("u", 3, 2)]
    base, full = [], []
    for q in range(4):
        keep = " ".join(f"WHEN NOT must AND initial = '{i}' THEN {_put('more', 'K', 'line', f'v{to}')}" for i, a, to in kept if a == q)
        role = f"'{name[free[q]]}'"
        base.append(f"least({_put('3', 'D', chr(39) * 2, f'v{q}')}, CASE {keep} END, "
                    f"CASE WHEN NOT must THEN {_put('2 + more', 'R', f'{role} || substr(line, length(role) + 1)', f'v{free[q]}')} END) AS b{q}")
        added = f"{role} || ':' || chr(10)"
        full.append(f"least(b{q}, {_put('2', 'I', added, f'b{free[q]}')}) AS v{q}")
    return ", ".join(base), ", ".join(full)


OP12 = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations),
x AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM c, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM x),
f AS (
  SELECT *, CASE WHEN {_BODY.format(t='text')} = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN right({_BODY.format(t='text')}, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o),
t AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
r AS (
  SELECT conv_id, n + 1 AS i, '0000000000 ' AS v0, '0000000004II user:' || chr(10) || 'assistant:' || chr(10) AS v1,
    '0000000002I assistant:' || chr(10) AS v2, '0000000000 ' AS v3
  FROM t
  UNION ALL
  SELECT conv_id, i, {_states()[1]} FROM (
    SELECT conv_id, i, {_states()[0]} FROM (
      SELECT r.conv_id, f.i, fault IN (1, 2) AS must, CASE fault WHEN 3 THEN 1 ELSE 0 END AS more, initial, role,
        role || ':' || text || chr(10) AS line, v0, v1, v2, v3
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i - 1))),
s AS (SELECT conv_id, v0 FROM r WHERE i = 1)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(substr(v0, 1, 10) AS BIGINT), 0) AS cost,
  coalesce(split_part(substr(v0, 11), ' ', 1), '') AS audit,
  sha256(coalesce(regexp_replace(substr(v0, 11 + strpos(substr(v0, 11), ' ')), '\n$', ''), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM k.conv_id
"""
