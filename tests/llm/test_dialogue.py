"""Conversation repair against an exhaustive search, and long conversations in blocks against a plain search from the end."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from tidemill.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def apply(edits, rows):
    """The rows that a string of edits makes."""
    return [(role or rows[at][0], rows[at][1] if at >= 0 else "") for at, role in dialogue.script(edits, [r[:1] for r, _ in rows], 0)]


def exhaustive(rows):
    """The best of all strings of edits that leave an orderly conversation: (cost, edits, rows)."""
    wrong, best = faults(rows), None
    todo = [(0, 0, "", ())]
    while todo:
        i, cost, edits, made = todo.pop()
        if cost > (best[0] if best else 3 * len(rows)):
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in made)):
            best = min(best or (cost, edits, made), (cost, edits, made))
        for role in ("user", "assistant"):
            todo.append((i, cost + 2, edits + "I", made + ((role, ""),)))
        if i < len(rows):
            role, text = rows[i]
            todo.append((i + 1, cost + 3, edits + "D", made))
            if wrong[i] not in (1, 2):
                more = wrong[i] == 3
                todo.append((i + 1, cost + more, edits + "K", made + ((role, text),)))
                todo += [(i + 1, cost + 2 + more, edits + "R", made + ((r, text),)) for r in ("user", "assistant")]
    return best


def from_the_end(rows):
    """The same by a plain search over (row, state), with the edits as text."""
    wrong = faults(rows)

    @functools.cache
    def best(i, state, inserted):
        out = []
        if inserted < 2:
            cost, edits = best(i, dialogue.FREE[state], inserted + 1)
            out.append((cost + 2, "I" + edits))
        if i == len(rows):
            if state in (0, 3):
                out.append((0, ""))
        else:
            out += [(c + d, letter + e) for letter, d, to in dialogue.row_edits(state, (rows[i][0][:1], wrong[i])) for c, e in [best(i + 1, to, 0)]]
        return min(out) if out else (10 ** 9, "")

    return best(0, 0, 0)


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ünd"]
    return [(rng.choice(roles[:rng.choice((3, 5, 8))]), rng.choice(["Yes.", "no", " ", "A b!", "x? \n", f"t{rng.random()}."])) for _ in range(n)]


def test_least_is_the_best_of_all():
    rng = random.Random(5)
    for n in list(range(5)) * 60:
        rows = [r for r in some_rows(rng, n) if r[0]]
        cost, edits, made = exhaustive(rows)
        given = list(zip([r[:1] for r, _ in rows], faults(rows)))
        assert dialogue.least(given, 0, dialogue.ENDS, True)[1:] == (cost, edits)
        assert dialogue.costs(given, True)[0][0] is not None and min(dialogue.costs(given, True)[0][q] for q in (0, 3)) == cost
        assert tuple(apply(edits, rows)) == made


def plain(conv_rows):
    """The query's row of a conversation, from its original (turn, role, text) rows."""
    conv, original = conv_rows
    rows = []
    for turn, role, text in original:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    rows = [r[1:] for r in rows]
    wrong = faults(rows)
    cost, audit = from_the_end(rows)
    made = apply(audit, rows)
    initials = [r[:1] for r, _ in rows]
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2 ** 63 - 1) if turns else 0
    pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in made)
    return (conv, gaps, wrong.count(1), wrong.count(2), wrong.count(3), pairs, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def check(spark, table):
    rows = [(conv, *r) for conv, original in table.items() for r in original]
    random.Random(1).shuffle(rows)
    given = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA + ", conv string, block string")
    got = sorted((tuple(r) for r in dialogue.damage_and_repair(given).collect()), key=str)
    assert got == sorted((plain(item) for item in table.items()), key=str)


def talk(rng, n):
    return [(t if rng.random() < 0.95 else None, *r) for t, r in enumerate(some_rows(rng, n))]


def test_tables(spark):
    rng = random.Random(7)
    table = {i: talk(rng, rng.randrange(12)) or [(0, "user", "Hi.")] for i in range(150)}
    table[None] = talk(rng, 9)
    table[2 ** 63 - 1] = [(-2 ** 63, "user", "a."), (2 ** 63 - 1, "assistant", "b.")]
    table[1000] = [(None, None, None), (None, None, None), (3, "user", "Same."), (3, "user", "Same."), (3, "assistant", "")]
    table[1001] = [(0, "user", "long. " * 200_000)]
    check(spark, table)


@pytest.mark.parametrize("block", [1, 3])
def test_long_conversations_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(dialogue, "BLOCK", block)
    rng = random.Random(block)
    check(spark, {0: talk(rng, 300), 1: [(t, "user", f"{t}.") for t in range(100)], 2: [(5, "assistant", "x")] * 50, 3: talk(rng, 3), None: talk(rng, 40)})


def test_empty_table(spark):
    assert dialogue.damage_and_repair(spark.createDataFrame([], SCHEMA)).collect() == []
