"""Merkle manifest of a table: one hash for all rows, and for each row the siblings that prove it.

Rows are leaves; those of a group (language) ascend by their key, runs of
ARITY consecutive digests become the digest of their concatenation until one
is left, the group's subroot, and the subroots make the root in the same way.

Spark gives every leaf its position: it deals the leaves by ranges of (group,
key), so a large group is spread, and counts each range. Blocks of ARITY **
LEVELS consecutive leaves, a bounded number, are subtrees that a task folds by
itself; what is left of the blocks is the next table of nodes, a few hundred
times smaller, and so on to the subroots and the root. On the way down every
block gets the siblings above it.

Midstates: a parent hashes its children one after the other and keeps a copy
of the hash state before each child's slot. Folding a replaced leaf takes the
copy before its slot and hashes the replacement and the siblings on its right;
what stands on the left isn't hashed again. The states above a block serve all
its leaves.

Defined cases: null values are ``-`` in a leaf; null keys come first in their
group, the null group first of all; rows with equal keys ascend by their leaf
(and by the digest that replaces it), equal rows are leaves each; a lone leaf
is its subroot, a lone subroot the root, with empty proofs; an empty table
gives an empty manifest; other columns are not read, so their names don't
matter. Texts are hashed whole.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch, parallelism, ship_package

ARITY = 8
LEVELS = 3               # levels that one task folds: blocks of 512 nodes
PATH = "array<struct<left:string,right:string>>"
NODE_PATHS = f"g string, pos long, subroot string, root string, path {PATH}"


def _part(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of the values, each as its UTF-8 length, ``:`` and itself, null as ``-``."""
    return F.sha2(F.concat(*[_part(c) for c in columns]), 256)


def depth(n: int) -> int:
    """Levels until one of n nodes is left."""
    d = 0
    while ARITY ** d < n:
        d += 1
    return d


class Subtree:
    """Runs of digests folded level by level, with the hash state before every child's slot."""

    def __init__(self, digests: list[bytes], levels: int):
        self.levels = []
        for _ in range(levels):
            states, left, right, up = [], [], [], []
            for i in range(0, len(digests), ARITY):
                run, h = digests[i:i + ARITY], sha256()
                for k, d in enumerate(run):
                    states.append(h.copy())
                    left.append(b"".join(run[:k]))
                    right.append(b"".join(run[k + 1:]))
                    h.update(d)
                up.append(h.hexdigest().encode())
            self.levels.append((states, left, right))
            digests = up
        self.top = digests

    def fold(self, i: int, digest: bytes) -> bytes:
        """The top with another digest at leaf i."""
        for states, _, right in self.levels:
            digest = resumed(states[i], digest, right[i])
            i //= ARITY
        return digest

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of leaf i and of the nodes above it, level by level."""
        out = []
        for _, left, right in self.levels:
            out.append((left[i], right[i]))
            i //= ARITY
        return out


def resumed(state, digest: bytes, right: bytes) -> bytes:
    """The parent's digest from a copied state, the child's digest and its right siblings."""
    h = state.copy()
    h.update(digest)
    h.update(right)
    return h.hexdigest().encode()


def fold_path(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The digest at the end of a path of siblings."""
    for left, right in path:
        digest = resumed(sha256(left), digest, right)
    return digest


def _positions(scratch: Scratch, rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with their position (pos) in their group g, and the group's size (total)."""
    spark = scratch.spark
    # the row's own number parts equal rows, which may be many
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    keys = ["g", *order, "_row"]
    dealt = numbered.repartitionByRange(parallelism(spark), *keys).sortWithinPartitions(*keys).drop("_row")
    dealt = scratch.write(dealt.withColumn("_at", F.monotonically_increasing_id()), f"{name}-dealt")
    spans = dealt.groupBy("g", F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    # a group has one row here for each range at most, however many leaves it has
    of_group = Window.partitionBy("g")
    before = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("g", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_n").over(of_group).alias("total"))
    placed = dealt.withColumn("_range", F.shiftright("_at", 33)).join(spans, ["g", "_range"])
    return placed.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY ** levels}"))


def _subtree(block: pa.Table, levels: int) -> tuple[Subtree, np.ndarray, list[bytes]]:
    """A block's subtree, the order of its rows and their digests in that order."""
    order = np.argsort(block.column("pos").to_numpy(), kind="stable")
    digests = [d.encode() for d in block.column("digest").take(pa.array(order)).to_pylist()]
    return Subtree(digests, min(levels, depth(block.column("total")[0].as_py()))), order, digests


def _raised(block: pa.Table, levels: int) -> pa.Table:
    tree, _, _ = _subtree(block, levels)
    total = block.column("total")[0].as_py()
    return pa.table({"g": block.column("g").slice(0, 1), "pos": block.column("block").slice(0, 1),
                     "total": pa.array([-(-total // ARITY ** levels)], pa.int64()), "digest": [d.decode() for d in tree.top]})


def _path_column(paths: list[list[tuple[bytes, bytes]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.array([[{"left": a.decode(), "right": b.decode()} for a, b in p] for p in paths], kind)


def _lowered(block: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """Nodes of a block with the siblings up to the root, from those of the block's own top."""
    tree, order, digests = _subtree(block, levels)
    n, up = len(digests), _path_of(above)
    taken = block.take(pa.array(order))
    return pa.table({"g": taken.column("g"), "pos": taken.column("pos"), "subroot": above.column("subroot").take(pa.array([0] * n)),
                     "root": above.column("root").take(pa.array([0] * n)),
                     "path": _path_column([tree.siblings(i) + up for i in range(n)])})


def _path_of(above: pa.Table) -> list[tuple[bytes, bytes]]:
    return [(x["left"].encode(), x["right"].encode()) for x in above.column("path")[0].as_py()]


def _proven(block: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """Leaves of a block with their proofs and what folding their replacements gives."""
    tree, order, digests = _subtree(block, levels)
    taken, up = block.take(pa.array(order)), _path_of(above)
    shared = b"".join(left + right for left, right in up)
    states = [(sha256(left), right) for left, right in up]
    proofs, folded = [], []
    for i, new in enumerate(taken.column("shown").to_pylist()):
        proofs.append(b"".join(left + right for left, right in tree.siblings(i)) + shared)
        digest = tree.fold(i, new.encode())
        for state, right in states:
            digest = resumed(state, digest, right)
        folded.append(digest)
    one = pa.array([0] * len(digests))
    return pa.table({"key": taken.column("key"), "leaf": taken.column("digest"), "subroot": above.column("subroot").take(one),
                     "root": above.column("root").take(one), "proof": pa.array(proofs, pa.binary()).cast(pa.string()),
                     "folded_root": pa.array(folded, pa.binary()).cast(pa.string())})


def _tower(scratch: Scratch, leaves: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """Tables of nodes (g, pos, total, digest), the leaves in blocks first, the last with one node a group."""
    out = [scratch.write(_in_blocks(leaves, levels), f"{name}-0")]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > 1:
        up = out[-1].select("g", "block", "pos", "total", "digest").groupBy("g", "block") \
            .applyInArrow(lambda block: _raised(block, levels), "g string, pos long, total long, digest string")
        out.append(scratch.write(_in_blocks(up, levels), f"{name}-{len(out)}"))
    return out


def _descend(scratch: Scratch, tower: list[DataFrame], tops: DataFrame, levels: int, name: str) -> DataFrame:
    """The siblings above every block of the lowest table, from those above each group's top (g, subroot, root, path)."""
    above = tops.withColumn("pos", F.lit(0).cast("long"))
    for k in range(len(tower) - 2, 0, -1):     # the nodes of a table are the blocks of the table below
        nodes = tower[k].select("g", "block", "pos", "total", "digest")
        above = scratch.write(_under(nodes, above, _lowered, levels, NODE_PATHS), f"{name}-paths-{k}")
    return above


def _under(nodes: DataFrame, above: DataFrame, task, levels: int, schema: str) -> DataFrame:
    tops = above.withColumnRenamed("pos", "block")
    return nodes.groupBy("g", "block").cogroup(tops.groupBy("g", "block")).applyInArrow(lambda a, b: task(a, b, levels), schema)


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", key: str = "doc_id",
             changed: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """key, leaf, subroot, root, proof and folded_root of every row.

    A leaf is the digest of ``fields`` (texts or integers) in their order.
    ``proof`` has the hex digests of the siblings, left to right, level by
    level up to the root. ``folded_root`` is the root that the siblings give
    for the row as it is shown: with the values of ``changed`` in place of the
    fields it names; it equals ``root`` exactly if the shown row is the
    manifest's.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "merkle")
    # null groups come first: "-" stands before "="
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    shown = [(changed or {}).get(f, F.col(f)) for f in fields]
    leaves = scratch.write(docs.select(named.alias("g"), F.col(key).alias("key"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                                       leaf_digest(shown).alias("shown")), "leaves")
    tower = _tower(scratch, _positions(scratch, leaves, ["key", "digest", "shown"], "leaves"), levels, "groups")
    scratch.drop("leaves")
    scratch.drop("leaves-dealt")
    subroots = tower[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    crown = _tower(scratch, _positions(scratch, subroots, ["name"], "subroots"), levels, "subroots")
    root = crown[-1].select("g", F.lit("").alias("subroot"), F.col("digest").alias("root"), F.expr(f"cast(array() as {PATH})").alias("path"))
    paths = _under(crown[0].select("g", "block", "pos", "total", "digest"), _descend(scratch, crown, root, levels, "subroots"), _lowered, levels, NODE_PATHS)
    names = crown[0].select("g", "pos", "name", F.col("digest").alias("own"))
    tops = scratch.write(paths.join(names, ["g", "pos"]).select(F.col("name").alias("g"), F.col("own").alias("subroot"), "root", "path"), "tops")
    kind = leaves.schema["key"].dataType.simpleString()
    proven = _under(tower[0].select("g", "block", "pos", "total", "key", "digest", "shown"), _descend(scratch, tower, tops, levels, "groups"), _proven, levels,
                    f"key {kind}, leaf string, subroot string, root string, proof string, folded_root string")
    return proven.withColumnRenamed("key", key)
