"""Repair of conversation structure at least cost.

A conversation is its rows by turn, null turns first; rows of one turn go by role, then text. It is in order if the first
letters of its roles read ``(s?(ua)+)?``: an optional system row, then user and assistant in turns. Faults of a row, of which
the first counts: blank (nothing but space characters), duplicate (role and text were seen earlier), truncated (the last
character that is no space is not one of ``.!?``). A repair is a string of edits, one letter each: K keeps a row (0), R gives
it the role user or assistant (2), D deletes it (3; blank and duplicate rows must go), I inserts a row without text (2).
A truncated row that stays costs 1 more. Of all cheapest repairs the one with the least string (in ASCII) is taken.

One number decides both. The weight of a path through a conversation's edits has its cost in the high digits; the low digits are
its letters at fixed places from the left, one digit each (D 1, I 2, K 3, R 4), 0 where it has ended. A shorter string is thus below
its continuations, and the least number over the graph of (rows done, rows inserted, role last written) is the wanted repair.

Conversations of any length. Rows are cut into blocks of ``BLOCK``; a block's path ends with the letter of its last row, so that
no path's string is the start of another's, and the first block in which two repairs differ decides. Per block and pair of
states the least costs are found, folded from the end to what each state still costs, added to the high digits, and the least
number is found per block and state that it can be entered in. The states actually entered are then read off block by block.
What meets in one place per conversation is a few numbers per block, and the letters and digests that are its result.

Rows: null roles and texts count as one space, null turns as no turn (they come first, and gaps ignore them). A null id is a
conversation like any other. Equal rows of one turn stay side by side: all but the first are duplicates. A role without a first
letter cannot be kept. A conversation without rows has zeros, an empty string of edits, and the digest of the empty text. An empty
table gives an empty result. Extra columns are not read. Gaps beyond the largest long are given as that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import narrow, stored
from tidemill.operators import ordered

BLOCK = 32
LETTERS = "DIKR"  # in ASCII order: digits 1 to 4
DIGIT = 3         # bits of a digit
DELETE, INSERT, REROLE, CUT_SHORT = 3, 2, 2, 1
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FREE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what a row of a chosen role leads to
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
ENDS = [0, None, None, 0]  # what is still to pay at the end of a conversation
SPACES = " \t\n\v\f\r"
MOST = 2 ** 63 - 1
PLACE = ["conv", "_chunk", "block"]

Row = tuple[str, int]  # first letter of the role, fault


def row_edits(state: int, row: Row) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of what can be done with a row."""
    initial, wrong = row
    yield "D", DELETE, state
    if wrong not in (BLANK, DUPLICATE):
        more = CUT_SHORT if wrong == TRUNCATED else 0
        if (state, initial) in KEPT:
            yield "K", more, KEPT[state, initial]
        yield "R", REROLE + more, FREE[state]


def costs(rows: Sequence[Row], last: bool) -> list[list[int]]:
    """Least cost of a block by state before and after. Rows are inserted before its rows, and after them if it is the last."""
    out = []
    for entry in STATES:
        now = {entry: 0}
        for i in range(len(rows) + 1):
            if i < len(rows) or last:
                for _ in range(2):
                    for state, paid in list(now.items()):
                        now[FREE[state]] = min(now.get(FREE[state], MOST), paid + INSERT)
            if i == len(rows):
                break
            after: dict[int, int] = {}
            for state, paid in now.items():
                for _, cost, to in row_edits(state, rows[i]):
                    after[to] = min(after.get(to, MOST), paid + cost)
            now = after
        out.append([now.get(state, MOST) for state in STATES])
    return out


def least(rows: Sequence[Row], entry: int, to_pay: Sequence[int | None], last: bool) -> tuple[int, int, str] | None:
    """(state after, cost, edits) of a block's least path from a state, given what each state after it still has to pay."""
    inserts = len(rows) + 2
    width = DIGIT * (len(rows) + inserts)

    def weight(cost: int, letter: str, at: int) -> int:
        return (cost << width) + ((LETTERS.index(letter) + 1) << (width - DIGIT * (at + 1)))

    now = {(0, entry): 0}  # by rows inserted and state
    for i in range(len(rows) + 1):
        if i < len(rows) or last:
            for k in range(inserts):
                for state in STATES:
                    if (k, state) in now:
                        to, new = (k + 1, FREE[state]), now[k, state] + weight(INSERT, "I", i + k)
                        if new < now.get(to, new + 1):
                            now[to] = new
        if i == len(rows):
            break
        after: dict[tuple[int, int], int] = {}
        for (k, state), value in now.items():
            for letter, cost, to in row_edits(state, rows[i]):
                new = value + weight(cost, letter, i + k)
                if new < after.get((k, to), new + 1):
                    after[k, to] = new
        now = after
    ends = [(value + (to_pay[state] << width), state) for (_, state), value in now.items() if to_pay[state] is not None]
    if not ends:
        return None
    value, state = min(ends)
    digits = [value >> width - DIGIT * (at + 1) & (1 << DIGIT) - 1 for at in range(width // DIGIT)]
    return state, (value >> width) - to_pay[state], "".join(LETTERS[d - 1] for d in digits if d)


def script(edits: str, initials: Sequence[str], entry: int) -> list[tuple[int, str | None]]:
    """The rows that a string of edits makes: (number of the old row or -1, its role if that is a new one)."""
    out, at, state = [], 0, entry
    for letter in edits:
        if letter == "I":
            state = FREE[state]
            out.append((-1, ROLE[state]))
            continue
        if letter == "K":
            state = KEPT[state, initials[at]]
            out.append((at, None))
        elif letter == "R":
            state = FREE[state]
            out.append((at, ROLE[state]))
        at += 1
    return out


_TOTALS = T.StructType([T.StructField(n, T.LongType()) for n in ("gaps", "illegal")]
                       + [T.StructField("to_pay", T.ArrayType(T.ArrayType(T.LongType())))])
_TABLE = T.ArrayType(T.LongType())
_MOVES = T.ArrayType(T.StructType([T.StructField("to", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("edits", T.StringType())]))
_READ = T.StructType([T.StructField("entries", T.ArrayType(T.IntegerType())), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
_SCRIPT = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("role", T.StringType())]))


def _each(fn, kind: T.DataType):
    """A column function that calls a small function on each row's values, a few rows at a time."""

    @F.arrow_udf(kind)
    def run(*columns: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type
        out = []
        for at in range(0, len(columns[0]), 256):
            out += [fn(*values) for values in zip(*[c.slice(at, 256).to_pylist() for c in columns])]
        return pa.array(out, to_arrow_type(kind))

    return run


def _table(initials: list[str], faults: list[int], last: bool) -> list[int]:
    return [c for line in costs(list(zip(initials, faults)), last) for c in line]


def illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _total(blocks: list[dict]) -> dict:
    """A conversation's gaps and illegal pairs, and what each state after each block still has to pay."""
    to_pay: list[list[int | None]] = [ENDS]
    for block in reversed(blocks[1:]):
        pay, own = to_pay[-1], block["table"]
        sums = [[own[4 * a + b] + pay[b] for b in STATES if pay[b] is not None and own[4 * a + b] < MOST] for a in STATES]
        to_pay.append([min(s) if s else None for s in sums])
    timed = [b for b in blocks if b["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    turns = sum(b["turns"] for b in timed) - shared
    gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
    wrong = sum(b["illegal"] for b in blocks) + sum(illegal([a["last"], b["first"]]) for a, b in zip(blocks, blocks[1:]))
    return {"gaps": min(gaps, MOST), "illegal": wrong, "to_pay": to_pay[::-1]}


def _moves(initials: list[str], faults: list[int], to_pay: list[int | None], number: int, of: int) -> list[dict | None]:
    """For each state that a block can be entered in: the state after it, and its cost and edits."""
    rows = list(zip(initials, faults))
    found = [least(rows, state, to_pay, number == of - 1) if number or state == START else None for state in STATES]
    return [None if f is None else {"to": f[0], "cost": f[1], "edits": f[2]} for f in found]


def _read_off(moves: list[list[dict | None]]) -> dict:
    """The state that each block is entered in, and the cost and edits of all."""
    state, entries, cost, edits = START, [], 0, []
    for block in moves:
        entries.append(state)
        cost += block[state]["cost"]
        edits.append(block[state]["edits"])
        state = block[state]["to"]
    return {"entries": entries, "cost": cost, "audit": "".join(edits)}


def _script(initials: list[str], edits: str, entry: int) -> list[dict]:
    return [{"at": at, "role": role} for at, role in script(edits, initials, entry)]


def _blocks(rows: DataFrame) -> DataFrame:
    """(conv, _chunk, block, items, initials, faults, ..): runs of up to BLOCK rows in order, within the table's sorted ranges."""
    order = ["turn", "role", "text"]
    body = F.rtrim("text", F.lit(SPACES))
    alone = F.when(body == "", BLANK).when(~F.right(body, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    ranges = ordered.cut(rows, ["conv"], order)
    number = F.row_number().over(Window.partitionBy("conv", "_chunk").orderBy(*order))
    numbered = ranges.withColumn("rn", number).withColumn("block", F.expr(f"(rn - 1) div {BLOCK}"))
    seen = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    first = numbered.groupBy("conv", seen.alias("seen")).agg(F.min(F.struct("_chunk", "rn", "block")).alias("at"))
    firsts = first.groupBy("conv", "at._chunk", "at.block").agg(F.collect_list("at.rn").alias("firsts"))
    firsts = firsts.withColumnsRenamed({c: f"_{c}" for c in PLACE})
    items = numbered.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct(
        "rn", "turn", "role", "text", F.left("role", F.lit(1)).alias("initial"), alone.alias("fault")))).alias("items"))
    met = items.join(firsts, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE], "left")
    fresh = lambda r: F.coalesce(F.array_contains("firsts", r["rn"]), F.lit(False))
    out = met.select(
        *PLACE, F.transform("items", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("items"),
        F.transform("items", lambda r: r["initial"]).alias("initials"),
        F.transform("items", lambda r: F.when(r["fault"] == BLANK, BLANK).when(~fresh(r), DUPLICATE).otherwise(r["fault"])).alias("faults"),
        F.filter(F.transform("items", lambda r: r["turn"]), lambda v: v.isNotNull()).alias("turn"))
    pairs = F.zip_with(F.slice("initials", F.lit(1), F.size("initials") - 1), F.slice("initials", F.lit(2), F.size("initials")), lambda a, b: F.concat(a, b))
    return stored(out.select(
        *PLACE, "items", "initials", "faults", F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL))).cast("long").alias("illegal"),
        F.col("initials")[0].alias("first"), F.element_at("initials", -1).alias("last"), F.size(F.array_distinct("turn")).cast("long").alias("turns"),
        F.array_min("turn").alias("low"), F.array_max("turn").alias("high")), "dialogue-blocks")


def _per_conversation(blocks: DataFrame, *columns: Column | str) -> DataFrame:
    """(conv, blocks): one row per conversation, with the given columns of its blocks in order."""
    return blocks.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("_chunk", "block", *columns))).alias("blocks"))


def _places() -> Column:
    return F.transform("blocks", lambda b: F.struct(b["_chunk"].alias("_chunk"), b["block"].alias("block"))).alias("at")


def _with_tables(folded: DataFrame) -> DataFrame:
    """Conversations (conv, blocks) with the cost table of each block, where there are several."""
    long = folded.where(F.size("blocks") > 1).select("conv", F.size("blocks").alias("of"), F.posexplode("blocks").alias("number", "b"))
    table = _each(_table, _TABLE)("b.initials", "b.faults", F.col("number") == F.col("of") - 1)
    kept = [f"b.{c}" for c in ("illegal", "first", "last", "turns", "low", "high")]
    several = _per_conversation(long.select("conv", "b._chunk", "b.block", *kept, table.alias("table")),
                                *[c.removeprefix("b.") for c in kept], "table")
    single = folded.where(F.size("blocks") == 1).select("conv", F.transform("blocks", lambda b: F.struct(
        *[b[c].alias(c) for c in ("_chunk", "block", *[k.removeprefix("b.") for k in kept])], F.lit(None).cast(_TABLE).alias("table"))).alias("blocks"))
    return several.unionByName(single)


def _count(kind: int) -> Column:
    return F.sum(F.size(F.filter("faults", lambda f: f == kind))).cast("long")


@dataclass(frozen=True)
class Repair:
    """``report``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation that has rows.
    ``pieces``: (conv, _chunk, block, lines), the repaired rows (role, text) in order of _chunk and block."""

    report: DataFrame
    pieces: DataFrame


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    cut = narrow(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    blocks = _blocks(cut.select("conv", F.col("turn").cast("long").alias("turn"), text("role"), text("text")))
    folded = _per_conversation(blocks, "illegal", "first", "last", "turns", "low", "high", "initials", "faults")
    totals = _with_tables(stored(folded, "dialogue-folded"))
    totals = stored(totals.select("conv", _each(_total, _TOTALS)("blocks").alias("t"), _places()), "dialogue-totals")
    pay = totals.select("conv", F.posexplode(F.arrays_zip("at", "t.to_pay")).alias("number", "of_block"), F.size("at").alias("of"))
    pay = pay.select("conv", "of_block.at._chunk", "of_block.at.block", "of_block.to_pay", "number", "of")
    moved = ordered.null_safe_join(blocks.select(*PLACE, "initials", "faults"), pay, PLACE)
    moved = stored(moved.select(*PLACE, "initials", _each(_moves, _MOVES)("initials", "faults", "to_pay", "number", "of").alias("moves")),
                   "dialogue-moves")
    read = _per_conversation(moved, "moves")
    read = stored(read.select("conv", _places(), _each(_read_off, _READ)(F.transform("blocks", lambda b: b["moves"])).alias("r")), "dialogue-edits")
    entered = read.select("conv", F.explode(F.arrays_zip("at", "r.entries")).alias("e"))
    entered = entered.select("conv", "e.at._chunk", "e.at.block", F.col("e.entries").alias("entry"))
    chosen = ordered.null_safe_join(moved, entered, PLACE).select(
        *PLACE, _each(_script, _SCRIPT)("initials", F.get("moves", F.col("entry"))["edits"], "entry").alias("script"))
    old = lambda r, c: F.element_at("items", r["at"] + 1)[c]
    line = lambda r: F.when(r["at"] < 0, F.struct(r["role"].alias("role"), F.lit("").alias("text"))).otherwise(
        F.struct(F.coalesce(r["role"], old(r, "role")).alias("role"), old(r, "text").alias("text")))
    pieces = ordered.null_safe_join(blocks.select(*PLACE, "items"), chosen, PLACE).select(*PLACE, F.transform("script", line).alias("lines"))
    counts = blocks.groupBy("conv").agg(_count(BLANK).alias("blank"), _count(DUPLICATE).alias("duplicate"), _count(TRUNCATED).alias("truncated"))
    report = ordered.null_safe_join(ordered.null_safe_join(counts, totals.select("conv", "t.gaps", "t.illegal"), ["conv"]),
                                    read.select("conv", "r.cost", "r.audit"), ["conv"])
    return Repair(report, pieces)


def digests(pieces: DataFrame, conv_type: T.DataType) -> DataFrame:
    """(conv, repaired_sha256): the digest of each conversation's lines ``role:text``, joined by line ends, read as a stream."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
        conv, running, begun = None, None, False
        for batch in batches:
            done = []
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                if running is None or key != conv:
                    if running is not None:
                        done.append((conv, running.hexdigest()))
                    conv, running, begun = key, hashlib.sha256(), False
                if (text := part.as_py()) is not None:
                    running.update((("\n" if begun else "") + text).encode())
                    begun = True
            if done:
                yield pa.record_batch([pa.array(c) for c in zip(*done)], schema=schema)
        if running is not None:
            yield pa.record_batch([pa.array([conv]), pa.array([running.hexdigest()])], schema=schema)

    line = F.transform("lines", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    text = F.when(F.size("lines") > 0, F.array_join(line, "\n"))
    streams = pieces.select(F.col("conv").cast("string").alias("conv"), "_chunk", "block", text.alias("text"))
    streams = streams.repartition("conv").sortWithinPartitions("conv", "_chunk", "block").select("conv", "text")
    return streams.mapInArrow(hashed, "conv string, repaired_sha256 string").withColumn("conv", F.col("conv").cast(conv_type))


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with every fault planted in a twentieth of the rows, by a hash of id and turn."""
    cut = narrow(rows, conv_id="conv_id", turn="turn", role="role", text="text")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    changed = cut.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return changed.drop("copy")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the undamaged table: what is wrong with its damaged rows, and the digest of their repair."""
    done = repair(damaged(conversations))
    all_ = narrow(conversations, conv="conv_id").distinct()
    kind = all_.schema["conv"].dataType
    right = ordered.null_safe_join(done.report, digests(done.pieces, kind), ["conv"]).withColumnRenamed("conv", "_conv")
    met = all_.join(right, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return met.select(F.col("conv").alias("conv_id"), *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
