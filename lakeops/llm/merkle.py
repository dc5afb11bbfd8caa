"""Merkle manifest of a dataset: a tree of SHA-256 digests for each group of rows,
a tree over the groups' subroots, a proof for each row, and roots folded anew from
changed leaves.

A node is the digest of its children's hex digests one after the other; ``arity``
consecutive nodes make a node, the last of a level from fewer, even from one, until
one node remains.  A parent keeps a copy of its hash state before each child slot
(the midstate), so folding a changed child resumes the copy of its slot with the
replacement and the siblings right of it; what stands left is not hashed again.

Blocks of ``span`` (the largest power of ``arity`` up to 1024) consecutive leaves
make their subtree in one task, their nodes are dealt into blocks again, and so on:
a group of n leaves takes log n / log 1024 rounds, and no task holds more than a block.
On the way down each block meets the path of its top node, one (left, right) pair of
sibling strings a level, from which it sets up the states of the parents above it
once; the leaves of the block fold through its own states and through those.

Cases: null values are hashed as ``-``, so a null and an empty text differ; a null
group comes first among the groups, a null key first in its group; rows of one key
stand by their digests, and equal rows next to each other, each with its own proof;
an empty table gives no rows; columns other than the hashed ones are not looked at.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lakeops.llm._common import map_slices, stored
from lakeops.llm.places import ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
BLOCK = 1024
SLICE = 4                      # blocks that a Python worker unpacks at a time

PATH = ArrayType(StructType([StructField("left", StringType()), StructField("right", StringType())]))


def digest(values: list[Column]) -> Column:
    """Hex SHA-256 of the strings: ``-`` for a null, else length in bytes, ``:``, value."""
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]), 256)


class Tree:
    """The levels of parents above some nodes, each with its children and its hash
    state before each of them."""

    def __init__(self, nodes: list[bytes], arity: int, height: int | None):
        """``height``: so many levels, or (None) up to a single node."""
        self.arity, self.levels = arity, []
        while len(nodes) > 1 if height is None else len(self.levels) < height:
            runs = [nodes[i:i + arity] for i in range(0, len(nodes), arity)]
            states, nodes = [], []
            for run in runs:
                state, before = hashlib.sha256(), []
                for child in run:
                    before.append(state.copy())
                    state.update(child)
                states.append(before)
                nodes.append(state.hexdigest().encode())
            self.levels.append((runs, states))
        self.top = nodes[0]

    def path(self, i: int) -> list[tuple[bytes, bytes]]:
        """(siblings left, siblings right) of the i-th node, level by level."""
        out = []
        for runs, _ in self.levels:
            i, slot = divmod(i, self.arity)
            out.append((b"".join(runs[i][:slot]), b"".join(runs[i][slot + 1:])))
        return out

    def fold(self, i: int, node: bytes) -> bytes:
        """The top with ``node`` in place of the i-th."""
        for runs, states in self.levels:
            i, slot = divmod(i, self.arity)
            node = resume(states[i][slot], node, runs[i][slot + 1:])
        return node


def resume(state, node: bytes, right: list[bytes]) -> bytes:
    """The digest of a parent from its state before a slot, the child put there and
    the children after it."""
    state = state.copy()
    state.update(node)
    for r in right:
        state.update(r)
    return state.hexdigest().encode()


def heights(arity: int) -> tuple[int, int]:
    """(leaves of a block, levels above them)"""
    height = 1
    while arity ** (height + 1) <= BLOCK:
        height += 1
    return arity ** height, height


def blocks(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """(g, b, total, items, top): nodes (g, pos, total, node, ...) in blocks of
    consecutive places, items sorted by place, and the node above each block."""
    span, height = heights(arity)
    rest = [c for c in nodes.columns if c not in ("g", "pos", "total")]
    rows = (nodes.groupBy("g", F.floor(F.col("pos") / span).cast("long").alias("b"))
            .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("items")))

    def make():
        def step(batch):
            tops = [Tree([x.encode() for x in items.field("node").to_pylist()], arity,
                         height if total > span else None).top.decode()
                    for total, items in zip(batch.column(2).to_pylist(), structs(batch.column(3)))]
            return [*batch.columns, tops]
        return step

    return stored(map_slices(rows, make, StructType([*rows.schema.fields, StructField("top", StringType())]), SLICE), name)


def structs(lists: pa.ListArray) -> list[pa.StructArray]:
    """The structs of each list."""
    return [lists.values.slice(a, b - a) for a, b in zip(lists.offsets.to_pylist(), lists.offsets.to_pylist()[1:])]


def forest(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Tables of blocks from the leaves up, and (g, top) of every group."""
    span, _ = heights(arity)
    levels = [blocks(nodes, arity, f"{name}-0")]
    most = levels[0].agg(F.max("total")).first()[0] or 0
    while most > span:
        most = -(-most // span)
        up = levels[-1].select("g", F.col("b").alias("pos"), F.ceil(F.col("total") / span).cast("long").alias("total"),
                               F.col("top").alias("node"))
        # groups that are a single node already pass through as trees without levels
        levels.append(blocks(up, arity, f"{name}-{len(levels)}"))
    return levels, levels[-1].select("g", "top")


def met(level: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path of their top node."""
    above = paths.select(F.col("g").alias("_g"), F.col("pos").alias("_b"), "path")
    return level.join(above, (F.col("g") == F.col("_g")) & (F.col("b") == F.col("_b"))).drop("_g", "_b")


def below(level: DataFrame, paths: DataFrame, arity: int, name: str) -> DataFrame:
    """(g, pos, path) of every node of the blocks, path from that node to the top."""
    span, height = heights(arity)

    def make():
        def step(batch):
            out = [[], [], []]
            for g, total, items, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             structs(batch.column(2)), batch.column(3).to_pylist()):
                nodes = [x.encode() for x in items.field("node").to_pylist()]
                tree = Tree(nodes, arity, height if total > span else None)
                for i, pos in enumerate(items.field("pos").to_pylist()):
                    out[0].append(g)
                    out[1].append(pos)
                    out[2].append([{"left": a.decode(), "right": b.decode()} for a, b in tree.path(i)] + path)
            return out
        return step

    rows = met(level, paths).select("g", "total", "items", "path")
    return stored(map_slices(rows, make, StructType([
        StructField("g", StringType()), StructField("pos", LongType()), StructField("path", PATH)]), SLICE), name)


def folded(level: DataFrame, paths: DataFrame, arity: int) -> DataFrame:
    """(key, leaf, proof, folded_root) of every leaf: the siblings' digests level by
    level, and the root with the item's ``other`` leaf, where it has one, in its place."""
    span, height = heights(arity)
    key = level.schema["items"].dataType.elementType["key"].dataType

    def make():
        def step(batch):
            out = [[], [], [], [], []]
            for g, total, items, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                             structs(batch.column(2)), batch.column(3).to_pylist()):
                leaves = [x.encode() for x in items.field("node").to_pylist()]
                tree = Tree(leaves, arity, height if total > span else None)
                above = [(hashlib.sha256(p["left"].encode()), p["right"].encode()) for p in path]
                tail = "".join(p["left"] + p["right"] for p in path)
                out[0] += [g] * len(leaves)
                out[1] += items.field("key").to_pylist()
                for i, (leaf, other) in enumerate(zip(leaves, items.field("other").to_pylist())):
                    node = tree.fold(i, other.encode() if other else leaf)
                    for state, right in above:
                        node = resume(state, node, [right])
                    out[2].append(leaf.decode())
                    out[3].append(b"".join(a + b for a, b in tree.path(i)).decode() + tail)
                    out[4].append(node.decode())
            return out
        return step

    rows = met(level, paths).select("g", "total", "items", "path")
    return map_slices(rows, make, StructType([
        StructField("g", StringType()), StructField("key", key), StructField("leaf", StringType()),
        StructField("proof", StringType()), StructField("folded_root", StringType())]), SLICE)


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS,
             key: str = "doc_id", group: str = "lang", arity: int = ARITY) -> DataFrame:
    """One row for each row of ``docs``: key, leaf, subroot, root, proof (hex digests
    of the siblings from the leaf to the root, each level from left to right),
    folded_root and verified.

    ``changed`` gives columns in place of fields for the folded leaves (the data as
    found now); where they hash as before, folding gives the root again.
    """
    own = [F.col(f).cast("string") for f in fields]
    now = [(changed or {}).get(f, F.col(f)).cast("string") for f in fields]
    differs = reduce(or_, [~a.eqNullSafe(b) for a, b in zip(own, now)])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"), F.col(key).alias("key"),
        digest(own).alias("node"), F.when(differs, digest(now)).alias("other"),
        F.monotonically_increasing_id().alias("row"))
    leaves = stored(leaves, "merkle-leaves")
    levels, subroots = forest(ranked(leaves, "g", ["key", "node", "row"], "merkle").drop("row"), arity, "merkle")
    groups = stored(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("top").alias("node")), "merkle-groups")
    heads, root = forest(ranked(groups, "g", ["key"], "merkle-top"), arity, "merkle-top")

    paths = root.select("g", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"))
    for i in range(len(heads) - 1, -1, -1):
        paths = below(heads[i], paths, arity, f"merkle-top-paths-{i}")
    names = heads[0].select("g", F.explode("items").alias("x")).select("g", "x.pos", "x.key", F.col("x.node").alias("subroot"))
    named = stored(names.join(paths, ["g", "pos"]).join(root, "g").withColumnRenamed("top", "root"), "merkle-named")
    paths = named.select(F.col("key").alias("g"), F.lit(0).cast("long").alias("pos"), "path")
    for i in range(len(levels) - 1, 0, -1):
        paths = below(levels[i], paths, arity, f"merkle-paths-{i}")
    of = named.select(F.col("key").alias("_g"), "subroot", "root")
    return (folded(levels[0], paths, arity).join(of, F.col("g") == F.col("_g"))
            .select(F.col("key").alias(key), "leaf", "subroot", "root", "proof", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
