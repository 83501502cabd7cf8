"""Manifests against plain trees in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemill.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """(root, steps of every leaf) by the definition."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            a = p - p % 16
            steps[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + 16])))
        nodes = [h("".join(nodes[a:a + 16])) for a in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], steps


def plain(rows):
    """Rows of the query, by the definition."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = tree([leaf(*r) for r in groups[g]])
    if not names:
        return []
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for r, steps in zip(groups[g], trees[g][1]):
            claim, text = leaf(*r), r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                claim = leaf(*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
            node = claim
            for left, right in steps + top:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in steps + top))
            out.append((r[0], leaf(*r), trees[g][0], root, proof, node, node == root))
    return sorted(out, key=str)


def rows(counts):
    out, i = [], 0
    for g, n in counts.items():
        for _ in range(n):
            out.append((i * 7 % 100003, g, "en", i, f"Text Number {i} É"))
            i += 1
    return out


EDGES = [(None, None, None, None, None), (None, None, None, None, None), (5, None, "en", 3, ""), (5, None, "en", 3, ""), (5, "a", "en", 4, "AbC"),
         (5, "a", "en", 4, "ABC"), (2 ** 63 - 1, "é", None, -1, "X" * 300_000), (-2 ** 63, "é", "", 0, "İSTANBUL"), (7, "", "x", 1, "lone")]


@pytest.mark.parametrize("given", [
    rows({"a": 1}), rows({None: 256, "hot": 5000, "z": 255, "y": 300, "x": 257, "b": 16, "c": 17}), rows({f"s{k}": 1 + k % 3 for k in range(40)}), EDGES, []])
def test_audit_is_the_plain_tree(spark, given):
    docs = spark.createDataFrame(given, SCHEMA)
    docs = docs.withColumns({c: F.lit("clash") for c in ("grp", "place", "leaf", "claim", "block", "TEXT_", "rn")})
    got = sorted((tuple(r) for r in manifest.audit(docs).collect()), key=str)
    assert got == plain(given)


def test_appends_end_in_the_same_manifest(spark):
    given = rows({"a": 700, None: 300, "b": 5})
    given.sort(key=lambda r: r[0])
    parts = [given[:3], given[3:400], given[400:402], given[402:]]
    blocks = manifest.grow(manifest.document_leaves(spark.createDataFrame(parts[0], SCHEMA)))
    for part in parts[1:]:
        blocks = manifest.append(blocks, manifest.document_leaves(spark.createDataFrame(part + [(10 ** 6 + len(part), f"new{len(part)}", "", 0, "t")], SCHEMA)))
    whole = given + [(10 ** 6 + len(p), f"new{len(p)}", "", 0, "t") for p in parts[1:]]
    want = manifest.grow(manifest.document_leaves(spark.createDataFrame(whole, SCHEMA)))
    read = lambda b: sorted((tuple(r) for r in manifest.witnesses(b).collect()), key=str)
    assert read(blocks) == read(want)
    with pytest.raises(ValueError):
        manifest.append(blocks, manifest.document_leaves(spark.createDataFrame([(0, "a", "", 0, "early")], SCHEMA)))


def test_a_full_block_is_not_grown_again(spark):
    blocks = manifest.grow(manifest.document_leaves(spark.createDataFrame(rows({"a": 300}), SCHEMA)))
    more = spark.createDataFrame([(10 ** 6 + i, "a", "", 0, "t") for i in range(3)], SCHEMA)
    after = manifest.append(blocks, manifest.document_leaves(more))
    assert after.where("block = 0").count() == 1 and after.where("block = 1").selectExpr("size(members)").first()[0] == 47
    new = set(after.inputFiles()) - set(blocks.inputFiles())
    read = [spark.read.parquet(f) for f in new]
    assert [r.block for t in read if "levels" in t.columns for r in t.collect()] == [1]


def test_witnesses_fold_to_the_root(spark):
    rows_ = manifest.witnesses(manifest.grow(manifest.document_leaves(spark.createDataFrame(rows({"a": 40, "b": 2, "c": 1}), SCHEMA)))).collect()
    assert len(rows_) == 43 and all(manifest.fold(r.leaf, r.steps) == r.root for r in rows_)
