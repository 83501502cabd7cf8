"""A manifest of a table as Merkle trees, grown by appending, with a witness for every leaf.

Each group (source) has a tree of fixed arity over its leaves in order, and the groups' roots are the leaves of one
more tree, whose root stands for the table. A tree grows by appends only. An appended leaf belongs to the open
subtrees at the right edge; its witness is partial until these are complete. When a run of siblings is complete, the
witness of every member, and with it of all leaves below, gains one step: the siblings left and right of it.

Leaves are dealt to blocks of ``ARITY ** LEVELS`` aligned places, so that blocks are whole subtrees: each is grown by
itself in some task (``Grower``), and its root is then appended to a tree of blocks, which is dealt to blocks in turn,
until one block holds all. On the way back the steps found for a block's root extend the witnesses of its leaves.
Leaves of a run share its digests, so a block keeps its nodes once and not a witness per leaf. What a task holds at a
time is one block. A group may hold any share of the rows.

``append`` adds leaves to a manifest: only the last, open block of a group is grown anew, complete ones stay as they are.

Rows. A null value has a digest of its own (``-``). Leaves of a group ascend by key, null first; equal keys ascend by
leaf, so rows equal in all columns are leaves side by side. A null group is a group and comes first. A lone leaf is its
group's root, and has no steps in it. An empty table has no rows in any result. Extra columns are not read.
Keys are whole numbers: a key that is text is cast, and one that cannot be cast is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import narrow, stored
from tidemill.operators import ordered

ARITY = 16
LEVELS = 2  # levels of a block; a block has ARITY ** LEVELS places
PLACES = ARITY ** LEVELS

_LEVELS = T.ArrayType(T.ArrayType(T.StringType()))
_STEPS = T.ArrayType(T.StringType())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels from n nodes up to a single one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Grower:
    """A tree that grows leaf by leaf.

    ``nodes[level]`` are the nodes so far; those after the last full run belong to open subtrees. A run that becomes full
    is complete at once: it makes its parent, and with that a step in the witness of all leaves below it.
    """

    def __init__(self, nodes: Sequence[Sequence[str]] = ()) -> None:
        self.nodes = [list(level) for level in nodes] or [[]]

    def append(self, node: str, level: int = 0) -> None:
        if level == len(self.nodes):
            self.nodes.append([])
        self.nodes[level].append(node)
        if len(self.nodes[level]) % ARITY == 0:
            self._complete(level, ARITY)

    def _complete(self, level: int, members: int) -> None:
        self.append(digest("".join(self.nodes[level][-members:])), level + 1)

    def close(self, levels: int) -> list[list[str]]:
        """Complete the open runs, with the members they have, from the leaves up to the given level."""
        for level in range(levels):
            if members := len(self.nodes[level]) % ARITY:
                self._complete(level, members)
        return self.nodes[:levels + 1]

    def step(self, leaf: int, level: int) -> tuple[str, str]:
        """The siblings left and right of the leaf's ancestor at a level, as text."""
        at = leaf // ARITY ** level
        first = at - at % ARITY
        run = self.nodes[level]
        return "".join(run[first:at]), "".join(run[at + 1:first + ARITY])

    def witness(self, leaf: int, levels: int) -> list[str]:
        """The leaf's steps, each as two texts: left siblings, right siblings."""
        return [side for level in range(levels) for side in self.step(leaf, level)]


def _rows(*columns: pa.Array) -> Iterator[tuple]:
    """Rows of several columns as Python values, a few blocks at a time."""
    for at in range(0, len(columns[0]), 16):
        yield from zip(*[c.slice(at, 16).to_pylist() for c in columns])


@F.arrow_udf(_LEVELS)
def _grown(leaves: pa.Array) -> pa.Array:
    """The nodes of each block, level by level."""
    out = []
    for block, in _rows(leaves):
        tree = Grower()
        for leaf in block:
            tree.append(leaf)
        out.append(tree.close(LEVELS))
    return pa.array(out, pa.list_(pa.list_(pa.string())))


@F.arrow_udf(T.ArrayType(_STEPS))
def _extended(levels: pa.Array, heights: pa.Array, above: pa.Array) -> pa.Array:
    """The witness of each leaf of a block: its steps in the block, then those of the block's root."""
    out = []
    for nodes, high, more in _rows(levels, heights, above):
        tree = Grower(nodes)
        out.append([tree.witness(i, high) + more for i in range(len(nodes[0]))])
    return pa.array(out, pa.list_(pa.list_(pa.string())))


def fold(node: str, steps: Sequence[str]) -> str:
    """The root that a leaf and its steps lead to."""
    for left, right in zip(steps[::2], steps[1::2]):
        node = digest(left + node + right)
    return node


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("proof", T.StringType()), T.StructField("folded", T.StringType())])))
def _judged(levels: pa.Array, heights: pa.Array, above: pa.Array, claims: pa.Array) -> pa.Array:
    """For each leaf of a block, the digest of its siblings, and the root that the claimed leaf leads to."""
    out = []
    for nodes, high, more, claimed in _rows(levels, heights, above, claims):
        tree, rows = Grower(nodes), []
        for i, claim in enumerate(claimed):
            steps = tree.witness(i, high) + more
            rows.append({"proof": digest("".join(steps)), "folded": fold(claim, steps)})
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("proof", pa.string()), ("folded", pa.string())])))


def field(c: Column) -> Column:
    """One value of a leaf: ``-`` for null, else its length in bytes, a colon, and itself."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _blocks(rows: DataFrame) -> DataFrame:
    """(grp, block, members, levels) of rows (grp, place, key, leaf, claim)."""
    member = F.struct("place", "key", "leaf", "claim")
    dealt = rows.groupBy("grp", F.expr(f"place div {PLACES}").alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return dealt.withColumn("levels", _grown(F.transform("members", lambda m: m["leaf"])))


def _placed(rows: DataFrame) -> DataFrame:
    """Rows (grp, key, leaf, claim) with their place in the group, from 0."""
    numbered = ordered.numbered(rows, ["grp"], ["key", "leaf"], "rn")
    return numbered.withColumn("place", F.col("rn") - 1).drop("rn")


def grow(rows: DataFrame) -> DataFrame:
    """The blocks of a manifest over rows (grp, key, leaf, claim); ``claim`` is the leaf to hold against the manifest.

    The rows are written first: they are read twice to be put in order, and the texts behind them are not.
    """
    return stored(_blocks(_placed(stored(rows, "manifest-leaves"))), "manifest-blocks")


def append(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """The manifest's blocks with more leaves appended.

    A new leaf's (key, leaf) must not be below those its group has, else ValueError. Only a group's last block is
    grown anew, and only if it is not full; the table of the other blocks is read as it is.
    """
    rows = stored(rows.select("grp", "key", "leaf", "claim"), "manifest-appended")
    ends = blocks.groupBy("grp").agg(F.max_by(F.struct(F.expr("element_at(members, -1)").alias("last"), "block"), "block").alias("end"))
    ends = ends.select("grp", F.col("end.block").alias("block"), F.col("end.last").alias("last"))
    first = rows.groupBy("grp").agg(F.min(F.struct("key", "leaf")).alias("first"))
    met = ordered.null_safe_join(first, ends, ["grp"])
    if not met.where(F.col("first") < F.struct("last.key", "last.leaf")).isEmpty():
        raise ValueError("appended leaves must follow the leaves of their group")
    met = met.select("grp", "block", (F.col("last.place") + 1).alias("taken"))
    reopened = met.where(F.col("taken") % PLACES != 0).select("grp", "block", F.lit(True).alias("open"))
    fresh = ordered.null_safe_join(_placed(rows), first.select("grp").join(
        met.withColumnsRenamed({"grp": "g"}), F.col("grp").eqNullSafe(F.col("g")), "left").select(
        "grp", F.coalesce("taken", F.lit(0)).alias("taken")), ["grp"])
    fresh = fresh.withColumn("place", F.col("place") + F.col("taken")).drop("taken")
    again = ordered.null_safe_join(blocks, reopened, ["grp", "block"]).select("grp", F.inline("members"))
    grown = stored(_blocks(fresh.unionByName(again)), "manifest-blocks")
    on = blocks["grp"].eqNullSafe(reopened["grp"]) & (blocks["block"] == reopened["block"])
    return blocks.join(reopened, on, "left_anti").unionByName(grown)


def _finished() -> Column:
    """Whether a block is its group's whole tree: the first one, and not full. (A full one may be the first of several.)"""
    return (F.col("block") == 0) & (F.size("members") < PLACES)


def _height() -> Column:
    """Levels of a block that its group's tree has: all, unless the block is the whole tree."""
    high = F.when(F.size("members") <= 1, 0)
    for k in range(1, LEVELS):
        high = high.when(F.size("members") <= ARITY ** k, k)
    return F.when(_finished(), high.otherwise(LEVELS)).otherwise(LEVELS)


def _rounds(blocks: DataFrame) -> list[DataFrame]:
    """The blocks of leaves, of their roots, of the roots of those .. until every group is one block that is not full."""
    rounds = [blocks]
    while True:
        up = rounds[-1].where(~_finished()).select(
            "grp", F.col("block").alias("place"), F.col("block").alias("key"), F.element_at(F.element_at("levels", -1), 1).alias("leaf"),
            F.lit(None).cast("string").alias("claim"))
        if up.isEmpty():
            return rounds
        rounds.append(stored(_blocks(up), "manifest-round"))


def _roots(rounds: Sequence[DataFrame]) -> DataFrame:
    """(grp, subroot) of every group."""
    top = F.element_at(F.element_at("levels", _height() + 1), 1)
    parts = [r.where(_finished()).select("grp", top.alias("subroot")) for r in rounds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _with_above(level: DataFrame, tops: DataFrame, above: DataFrame | None) -> DataFrame:
    """A round's blocks with the steps of their roots: from the round above, or, for whole trees, from the group."""
    done = ordered.null_safe_join(level.where(_finished()), tops, ["grp"])
    if above is None:
        return done
    below = ordered.null_safe_join(level.where(~_finished()), above.withColumnRenamed("place", "block"), ["grp", "block"])
    return done.unionByName(below)


def _climbed(blocks: DataFrame, tops: DataFrame, rounds: Sequence[DataFrame]) -> DataFrame:
    """The blocks of leaves with ``above`` (steps of the block's root to the table's root), subroot and root."""
    above = None
    for level in reversed(rounds[1:]):
        whole = _with_above(level, tops, above)
        steps = whole.withColumn("steps", _extended("levels", _height(), "above"))
        above = steps.select("grp", F.inline(F.arrays_zip("members", "steps")), "subroot", "root").select(
            "grp", F.col("members.place").alias("place"), F.col("steps").alias("above"), "subroot", "root")
        above = stored(above, "manifest-steps")
    return _with_above(blocks, tops, above)


def _tops(rounds: Sequence[DataFrame]) -> DataFrame:
    """(grp, above, subroot, root): the steps from each group's root to the table's, found by a tree over the groups."""
    subroots = stored(_roots(rounds), "manifest-roots")
    numbered = ordered.numbered(subroots.withColumn("one", F.lit(0)), ["one"], ["grp"], "rn")
    numbered = stored(numbered.select("grp", "subroot", (F.col("rn") - 1).alias("place")), "manifest-groups")
    leaves = numbered.select(F.lit("").alias("grp"), "place", F.col("place").alias("key"), F.col("subroot").alias("leaf"),
                             F.lit(None).cast("string").alias("claim"))
    above_all = _rounds(stored(_blocks(leaves), "manifest-blocks"))
    root = _roots(above_all).select("grp", F.array().cast("array<string>").alias("above"), F.col("subroot"), F.col("subroot").alias("root"))
    blocks = _climbed(above_all[0], root, above_all)
    steps = blocks.withColumn("steps", _extended("levels", _height(), "above"))
    steps = steps.select(F.inline(F.arrays_zip("members", "steps")), "root").select(
        F.col("members.place").alias("place"), F.col("steps").alias("above"), "root")
    return stored(numbered.join(steps, "place").select("grp", "above", "subroot", "root"), "manifest-tops")


def _whole(blocks: DataFrame) -> DataFrame:
    rounds = _rounds(blocks)
    return _climbed(blocks, _tops(rounds), rounds)


def witnesses(blocks: DataFrame) -> DataFrame:
    """(grp, key, leaf, claim, steps, subroot, root) of every leaf. ``steps``: left and right siblings as texts, level by level."""
    grown = _whole(blocks).withColumn("steps", _extended("levels", _height(), "above"))
    rows = grown.select("grp", F.inline(F.arrays_zip("members", "steps")), "subroot", "root")
    return rows.select("grp", "members.key", "members.leaf", "members.claim", "steps", "subroot", "root")


def verified(blocks: DataFrame) -> DataFrame:
    """(grp, key, leaf, subroot, root, proof, folded): the digest of each leaf's siblings, and the root its claim leads to."""
    claims = F.transform("members", lambda m: m["claim"])
    judged = _whole(blocks).withColumn("judged", _judged("levels", _height(), "above", claims))
    rows = judged.select("grp", F.inline(F.arrays_zip("members", "judged")), "subroot", "root")
    return rows.select("grp", "members.key", "members.leaf", "subroot", "root", "judged.proof", "judged.folded")


def document_leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """(grp, key, leaf, claim) of documents; ``claimed`` is the text to claim, an expression over id, source, lang, n_chars, text."""
    cut = narrow(docs, id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    columns = [F.col(c) for c in ("id", "source", "lang", "n_chars")]
    own = leaf(*columns, F.col("text"))
    return cut.select(F.col("source").cast("string").alias("grp"), F.col("id").cast("long").alias("key"), own.alias("leaf"),
                      (own if claimed is None else leaf(*columns, claimed)).alias("claim"))


def audit(docs: DataFrame) -> DataFrame:
    """Every document's leaf, roots and proof, and the outcome for a copy in which a fifth of the ids has its A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.crc32(F.col("id").cast("string")) % 5 == 0
    claimed = F.when(tampered, F.translate("text", upper, lower)).otherwise(F.col("text"))
    rows = verified(grow(document_leaves(docs, claimed)))
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
