"""Merkle dataset manifest: a digest of every row, of every group of rows and of the table, with a proof for each row.

H is the lowercase hex sha256 of its inputs one after the other, digests as hex text. A leaf is H of the row's fields, each
``-`` if null, else its number of UTF-8 bytes, ``:`` and the value. In each group the leaves ascend by their key; as long as
there are several nodes, every ``fanout`` consecutive ones become their H. What remains is the group's subroot, and
the subroots, by group (null first, bytewise), become the root likewise.

Method: SHA midstate tree. A parent keeps copies of the hash state before each child slot. Folding a claimed leaf into its
proof resumes at each level the state before its slot and adds the replacement and the siblings to the right only.

Leaves get their places by ranges of the order, so no group is gathered. A block of consecutive leaves (4,096: a whole subtree of
four levels) meets in one task and goes up as one node; the nodes again in blocks, until one is left. The way down gives each
block the runs its root lies in, up to the table's root (one row a block); hash states cannot leave a process, so the
parents of these runs are hashed once more for a block, and each of its leaves resumes them.

Defined results: null keys and equal keys are leaves like others, null first, equal keys by digest; rows equal in all fields have
equal leaves and are interchangeable; a group of one leaf has it as its subroot, with an empty proof below the subroots; an
empty table gives an empty one. Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from postura.llm.common import cut, join_small, ranked, reach_workers

ALL = -1  # the tree of the subroots; others are named by the first place of their group

NODE = "tree long, place long, n long, digest string"
PATH = "tree long, place long, path string, subroot string, root string"
PROVED = "doc_id long, leaf string, subroot string, root string, proof string, steps string, folded_root string"


def row_digest(fields: Sequence[Column]) -> Column:
    """H of the fields."""

    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


class Parent:
    """A run of children and the hash state before each of its slots."""

    def __init__(self, children: list[bytes]) -> None:
        self.children, self.before = children, []
        state = sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.right = [b"".join(children[i + 1 :]) for i in range(len(children))]

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child in a slot."""
        state = self.before[slot].copy()
        state.update(digest)
        state.update(self.right[slot])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot]) + self.right[slot]


@dataclass(frozen=True)
class Shape:
    """``fanout`` children a parent; a block is a subtree of ``levels`` levels."""

    fanout: int = 8
    levels: int = 4

    @property
    def block(self) -> int:
        return self.fanout**self.levels

    def grow(self, nodes: pa.Table) -> tuple[pa.Table, list[bytes], list[list[Parent]]]:
        """Nodes of one block in order, their digests, and the parents above them up to the block's top or the tree's."""
        nodes = nodes.sort_by("place")
        digests = [d.encode() for d in nodes["digest"].to_pylist()]
        grown, below, n = [], digests, nodes["n"][0].as_py()
        while n > 1 and len(grown) < self.levels:
            grown.append([Parent(below[i : i + self.fanout]) for i in range(0, len(below), self.fanout)])
            below, n = [p.digest for p in grown[-1]], -(-n // self.fanout)
        return nodes, digests, grown


def _raise(shape: Shape, nodes: pa.Table) -> pa.Table:
    """A block as one node of the next table."""
    nodes, digests, grown = shape.grow(nodes)
    top = grown[-1][0].digest if grown else digests[0]
    tree, place, n = (nodes[c][0].as_py() for c in ("tree", "place", "n"))
    return pa.table({"tree": [tree], "place": [place // shape.block], "n": [-(-n // shape.block)], "digest": [top.decode()]})


def _step(parent: Parent, slot: int) -> str:
    return f"{slot}:{b''.join(parent.children).decode()}"


def _path(steps: str) -> list[tuple[Parent, int]]:
    """Parents above a block, lowest first, and the slots that lead to it."""
    out = []
    for step in filter(None, steps.split(";")):
        slot, run = step.split(":")
        out.append((Parent([run[i : i + 64].encode() for i in range(0, len(run), 64)]), int(slot)))
    return out


def _lower(shape: Shape, nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Paths of the nodes of one block, from the path of the block."""
    nodes, digests, grown = shape.grow(nodes)
    end, subroot, root = (above[c][0].as_py() for c in ("path", "subroot", "root"))
    paths = []
    for i in range(len(digests)):
        own, at = [], i
        for parents in grown:
            own.append(_step(parents[at // shape.fanout], at % shape.fanout))
            at //= shape.fanout
        paths.append(";".join(filter(None, [*own, end])))
    n = len(paths)
    return pa.table({"tree": nodes["tree"], "place": nodes["place"], "path": paths, "subroot": [subroot] * n, "root": [root] * n})


def _prove(shape: Shape, leaves: pa.Table, above: pa.Table) -> pa.Table:
    """Proofs of the leaves of one block, and the roots that their claims fold to."""
    leaves, digests, grown = shape.grow(leaves)
    upper, subroot, root = _path(above["path"][0].as_py()), above["subroot"][0].as_py(), above["root"][0].as_py()
    upper_proof = b"".join(p.siblings(s) for p, s in upper).decode()
    upper_steps = [f"{s}/{len(p.children)}" for p, s in upper]
    known: dict[tuple[int, int], str] = {}  # siblings above the lowest level serve several leaves
    proofs, steps, folded = [], [], []
    for i, claim in enumerate(leaves["claim"].to_pylist()):
        digest, proof, way, at = claim.encode(), [], [], i
        for level, parents in enumerate(grown):
            parent, slot = parents[at // shape.fanout], at % shape.fanout
            if level == 0:
                proof.append(parent.siblings(slot).decode())
            else:
                if (level, at) not in known:
                    known[level, at] = parent.siblings(slot).decode()
                proof.append(known[level, at])
            way.append(f"{slot}/{len(parent.children)}")
            digest = parent.fold(slot, digest)
            at //= shape.fanout
        for parent, slot in upper:
            digest = parent.fold(slot, digest)
        proofs.append("".join([*proof, upper_proof]))
        steps.append(" ".join([*way, *upper_steps]))
        folded.append(digest.decode())
    n = len(proofs)
    columns = {"doc_id": leaves["doc_id"], "leaf": leaves["digest"], "subroot": [subroot] * n, "root": [root] * n}
    return pa.table({**columns, "proof": proofs, "steps": steps, "folded_root": folded})


def _blocks(shape: Shape, nodes: DataFrame) -> GroupedData:
    return nodes.groupBy("tree", F.floor(F.col("place") / shape.block).alias("_block"))


def _nodes(table: DataFrame, *more: str) -> DataFrame:
    return table.select("tree", "place", "n", "digest", *more)


def _climb(shape: Shape, nodes: DataFrame, most: int) -> list[DataFrame]:
    """Tables of nodes from ``nodes`` up to one node a tree; ``most`` is the largest number of nodes of a tree."""
    tables = [nodes]
    while most > 1:
        tables.append(cut(_blocks(shape, _nodes(tables[-1])).applyInArrow(lambda t: _raise(shape, t), NODE)))
        most = -(-most // shape.block)
    return tables


def _descend(shape: Shape, tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the lowest table, from the paths of the trees' tops."""
    for nodes in reversed(tables):
        above = paths.groupBy("tree", F.col("place").alias("_block"))
        paths = cut(_blocks(shape, _nodes(nodes)).cogroup(above).applyInArrow(lambda t, above: _lower(shape, t, above), PATH))
    return paths


def merkle_manifest(docs: DataFrame, leaf: Column, claim: Column, group: str = "lang", key: str = "doc_id", shape: Shape = Shape()) -> DataFrame:
    """One row for each row of ``docs``: ``leaf``, the ``subroot`` of its group, the ``root``, its ``proof`` (the siblings'
    digests level by level up to the root, left to right), the ``steps`` of the proof (slot/children at each level), the
    ``folded_root`` that the claimed leaf and the proof give, and ``verified``, whether it is the root."""
    reach_workers(docs.sparkSession)
    rows = cut(
        docs.select(
            F.col(group).cast("string").alias("_group"),
            F.col(key).cast("long").alias("doc_id"),
            leaf.alias("digest"),
            claim.alias("claim"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    order = [F.col(c).asc_nulls_first() for c in ("_group", "doc_id", "digest", "_row")]
    placed = cut(ranked(rows, order).drop("_row").withColumn("_known", F.col("_group").isNotNull()).withColumn("_name", F.coalesce("_group", F.lit(""))))
    trees = cut(placed.groupBy("_known", "_name").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("n")))
    leaves = join_small(placed, trees, ["_known", "_name"]).withColumn("place", F.col("place") - F.col("tree"))
    leaves = cut(leaves.select("tree", "place", "n", "digest", "doc_id", "claim"))
    groups, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    if not groups:
        return docs.sparkSession.createDataFrame([], f"{PROVED}, verified boolean")

    tables = _climb(shape, leaves, most)
    tops = ranked(tables[-1].select("tree", F.col("digest").alias("subroot")), [F.col("tree")])
    tops = cut(tops.select(F.lit(ALL).cast("long").alias("tree"), "place", F.lit(groups).alias("n"), F.col("subroot").alias("digest"), F.col("tree").alias("own")))
    over = _climb(shape, tops, groups)
    root = over[-1].first()["digest"]
    roots = over[-1].select("tree", "place", F.lit("").alias("path"), F.lit("").alias("subroot"), F.lit(root).alias("root"))
    over_paths = _descend(shape, over[:-1], roots).select("place", "path", "root")
    tree_paths = tops.select("place", F.col("own").alias("tree"), F.col("digest").alias("subroot")).join(over_paths, "place")
    tree_paths = cut(tree_paths.select("tree", F.lit(0).cast("long").alias("place"), "path", "subroot", "root"))
    paths = _descend(shape, tables[1:-1], tree_paths)
    above = paths.groupBy("tree", F.col("place").alias("_block"))
    proved = _blocks(shape, _nodes(leaves, "doc_id", "claim")).cogroup(above).applyInArrow(lambda t, above: _prove(shape, t, above), PROVED)
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
