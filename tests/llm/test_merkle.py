"""The manifest against a plain tree, proofs included."""

import hashlib

import pytest
from pyspark.sql import functions as F
from rows_util import ordered

from transitlens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, digest string, shown string, pos string, block string, key string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def up(nodes):
    return [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]


def folded(nodes, i, digest):
    """(top, digest folded from leaf i, its siblings)"""
    proof = ""
    while len(nodes) > 1:
        a = i // 8 * 8
        run = nodes[a:a + 8]
        proof += "".join(run[:i - a] + run[i - a + 1:])
        digest = H(*run[:i - a], digest, *run[i - a + 1:])
        nodes, i = up(nodes), i // 8
    return nodes[0], digest, proof


def plain(rows, change):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r), leaf(change(r))))
    leaves = {g: [leaf(r) for r in groups[g]] for g in order}
    tops = [folded(leaves[g], 0, "")[0] for g in order]
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            top, digest, proof = folded(leaves[g], i, leaf(change(r)))
            root, digest, more = folded(tops, k, digest)
            out.append((r[0], leaf(r), top, root, proof + more, digest))
    return ordered(out)


def lowered(r):
    return (*r[:4], r[4] if r[4] is None or r[0] is None or r[0] % 3 else r[4].translate({65 + k: 97 + k for k in range(26)}))


def made(spark, rows, parts=4, levels=merkle.LEVELS):
    df = spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA).repartition(parts)
    text = F.when(F.col("doc_id") % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    out = merkle.manifest(df, FIELDS, changed={"text": text}, levels=levels)
    return ordered([tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root").collect()])


@pytest.fixture(scope="module")
def rows():
    out = [(i * 7 % 1201, f"s{i % 5}", "en", i, f"Text {i} É Ü") for i in range(1201)]          # blocks of 512: three
    out += [(i, None, "ée", None, None if i % 4 == 0 else "A" * i) for i in range(65)]
    out += [(9000, "s", "zz", 1, "lone Leaf"), (9001, "s", None, 1, ""), (9003, "s", None, 1, "x\x00Y"), (None, "s", None, 2, "no ID"), (9002, "s", "", 1, "B")]
    out += [(9100, "s", "xx", 5, "equal Rows")] * 20 + [(9100, "s", "xx", 5, "other Row of the id")] * 2
    return out + [(9200 + k, "s", f"l{k}", 0, "long Text " * 2000) for k in range(9)]             # more than eight subroots


def test_manifest(spark, rows):
    assert made(spark, rows) == plain(rows, lowered)


def test_several_tables_of_nodes(spark, rows):
    """With small blocks the tower has more tables; nothing else changes."""
    some = rows[:300] + rows[1201:]
    assert made(spark, some, 3, 1) == plain(some, lowered)


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_few_rows(spark, n):
    few = [(i, "s", "en", i, "T") for i in range(n)]
    assert made(spark, few, 1) == plain(few, lowered) if n else made(spark, few, 1) == []


def test_midstates():
    digests = [hashlib.sha256(bytes([i])).hexdigest().encode() for i in range(70)]
    tree = merkle.Subtree(digests, merkle.depth(70))
    new = hashlib.sha256(b"new").hexdigest().encode()
    for i in (0, 7, 8, 63, 64, 69):
        other = [*digests[:i], new, *digests[i + 1:]]
        assert tree.fold(i, new) == merkle.Subtree(other, merkle.depth(70)).top[0]
        assert merkle.fold_path(new, tree.siblings(i)) == tree.fold(i, new)
        assert tree.fold(i, digests[i]) == tree.top[0]
