"""Dataset manifest: a Merkle tree of SHA-256 midstates over the rows of a table.

Every row is a leaf: the digest of its fields. The leaves of a source stand by id; runs of ``FAN``
consecutive nodes become one parent, level by level, until one node, the source's subroot,
remains. The subroots, by source, make the top tree in the same way; its last node is the root of the
dataset. A parent is the digest of its children's hex digests in a row. It keeps a copy of its hash state
before each child slot, so a changed child is folded in by resuming the state of its slot with the
new digest and the siblings to its right; what stands to its left is not hashed again.

Trees are cut into chunks of ``FAN ** HEIGHT`` consecutive nodes. A chunk is built, and later folded, in
one task that holds its nodes and states; chunk tops are the nodes of the next layer, which is
cut in the same way. So a source with a third of all rows is many tasks, and 100 billion leaves are three
layers. Paths go down layer by layer: a chunk gets the siblings above it, rebuilds the
states of those slots once, and resumes copies of them for each of its leaves. Places of leaves come
from one range partitioning; places in a partition are summed up by partition.

Defined results: a null field is ``-``, any other its UTF-8 length, ``:`` and its value; a null
source is a source of its own, the first; a null id stands before the others of its source; rows of one id stand by their
leaves; equal rows are equal leaves and have equal proofs or those of their neighbouring places, whichever of
them takes which; a single leaf is its own subroot, and a single subroot the root; a table without rows has no
root and no result. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stormlens.llm.storage import materialise

FAN = 3
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree string, pos long, size long, node string"
PATHS = "tree string, pos long, left array<string>, right array<string>, subroot string, root string"
OUT = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of the fields: length, ``:`` and value of each in a row."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


class Subtree:
    """Nodes in a row and ``levels`` levels of parents above them. For every node, ``states`` holds
    its parent's hash state before the node's slot."""

    def __init__(self, nodes: Sequence[bytes], levels: int):
        self.nodes, self.states = [list(nodes)], []
        for _ in range(levels):
            below, states, above = self.nodes[-1], [], []
            for first in range(0, len(below), FAN):
                state = hashlib.sha256()
                for child in below[first:first + FAN]:
                    states.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.states.append(states)
            self.nodes.append(above)

    def siblings(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """On each level, the siblings left and right of the node above place ``at``."""
        for nodes in self.nodes[:-1]:
            first = at - at % FAN
            yield b"".join(nodes[first:at]), b"".join(nodes[at + 1:first + FAN])
            at //= FAN

    def fold(self, at: int, node: bytes) -> bytes:
        """The top node if ``node`` stood at place ``at``."""
        for nodes, states in zip(self.nodes, self.states):
            state = states[at].copy()
            state.update(node)
            for right in nodes[at + 1:at - at % FAN + FAN]:
                state.update(right)
            node, at = state.hexdigest().encode(), at // FAN
        return node


class Above:
    """The levels above a chunk: the state of its slot on each, to be resumed with what is on the right."""

    def __init__(self, left: Sequence[str], right: Sequence[str]):
        self.sides = [(a.encode(), b.encode()) for a, b in zip(left, right)]
        self.states = [hashlib.sha256(a) for a, _ in self.sides]

    def fold(self, node: bytes) -> bytes:
        for kept, (_, right) in zip(self.states, self.sides):
            state = kept.copy()
            state.update(node)
            state.update(right)
            node = state.hexdigest().encode()
        return node


def levels(size: int, height: int) -> int:
    """How many levels a chunk of a layer of ``size`` nodes has above it: until one node of the layer
    is left, at most ``height``."""
    n = 0
    while n < height and size > 1:
        size, n = -(-size // FAN), n + 1
    return n


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place within ``tree`` by ``order``, and ``size``, the tree's rows."""
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(64))  # parts rows that are equal; any order of theirs is right
    kept = materialise(rows.repartitionByRange(tree, *order, spread).sortWithinPartitions(tree, *order)
                       .withColumn("__at", F.monotonically_increasing_id()), "ranked").withColumn("__part", F.shiftright("__at", 33))
    parts = kept.groupBy(F.col(tree).alias("__tree"), F.col("__part").alias("__of")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = W.partitionBy("__tree").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn("size", F.sum("__n").over(W.partitionBy("__tree")))
    return kept.join(parts, (F.col(tree) == F.col("__tree")) & (F.col("__part") == F.col("__of"))) \
        .withColumn("pos", F.col("__before") + F.col("__at") - F.col("__first")).select(*rows.columns, "pos", "size")


def _in_chunks(nodes: DataFrame, height: int):
    return nodes.withColumn("chunk", F.floor(F.col("pos") / FAN ** height)).groupBy("tree", "chunk")


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _subtree(table: pa.Table, height: int) -> Subtree:
    return Subtree([x.encode() for x in table.column("node").to_pylist()], levels(table.column("size")[0].as_py(), height))


def climb(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The layers above ``nodes`` (tree, pos, size, node), each the chunk tops of the one below; the last has one node
    a tree."""
    def tops(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        size = table.column("size")[0].as_py()
        top = _subtree(table, height).nodes[-1][0].decode()
        row = {"tree": table.column("tree")[0].as_py(), "pos": table.column("chunk")[0].as_py(), "size": -(-size // FAN ** height), "node": top}
        return pa.Table.from_pylist([row], pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("node", pa.string())]))

    layers = []
    while True:
        nodes = materialise(_in_chunks(nodes.select("tree", "pos", "size", "node"), height).applyInArrow(tops, NODES), "layer")
        layers.append(nodes)
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            return layers


def _paths(nodes: pa.Table, above: pa.Table, height: int) -> pa.Table:
    nodes, top = _ordered(nodes), above.to_pylist()[0]
    subtree, out = _subtree(nodes, height), []
    for at, (tree, pos) in enumerate(zip(nodes.column("tree").to_pylist(), nodes.column("pos").to_pylist())):
        sides = [(a.decode(), b.decode()) for a, b in subtree.siblings(at)]
        out.append({"tree": tree, "pos": pos, "left": [a for a, _ in sides] + top["left"], "right": [b for _, b in sides] + top["right"],
                    "subroot": top["subroot"], "root": top["root"]})
    text = pa.string()
    return pa.Table.from_pylist(out, pa.schema([("tree", text), ("pos", pa.int64()), ("left", pa.list_(text)), ("right", pa.list_(text)), ("subroot", text), ("root", text)]))


def _beside(nodes: DataFrame, above: DataFrame, height: int):
    """The chunks of ``nodes``, each with the path above it."""
    return _in_chunks(nodes, height).cogroup(above.withColumn("chunk", F.col("pos")).groupBy("tree", "chunk"))


def _down(layers: Sequence[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The paths of the nodes of the lowest of ``layers``, from the paths of the trees' last nodes."""
    for nodes in reversed(layers[:-1]):
        above = materialise(_beside(nodes, above, height).applyInArrow(lambda n, a: _paths(n, a, height), PATHS), "paths")
    return above


def _verify(leaves: pa.Table, above: pa.Table, height: int) -> pa.Table:
    leaves, top = _ordered(leaves), above.to_pylist()[0]
    subtree, up = _subtree(leaves, height), Above(top["left"], top["right"])
    outer = b"".join(a + b for a, b in up.sides)
    proofs, folded = [], []
    for at, node in enumerate(leaves.column("now").to_pylist()):
        proofs.append(hashlib.sha256(b"".join(a + b for a, b in subtree.siblings(at)) + outer).hexdigest())
        folded.append(up.fold(subtree.fold(at, node.encode())).decode())
    n = len(leaves)
    return pa.table({"id": leaves.column("id").cast(pa.int64()), "leaf": leaves.column("node").cast(pa.string()), "subroot": pa.array([top["subroot"]] * n, pa.string()),
                     "root": pa.array([top["root"]] * n, pa.string()), "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


class Manifest(NamedTuple):
    """``leaves``: tree, pos, size, id, node (the leaf) and now (the leaf of the row as it is now); ``layers`` above
    them; ``subroots``: tree, pos, size, node and of (its source) in the top tree; ``top``: its layers."""

    leaves: DataFrame
    layers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    height: int

    def root(self) -> str | None:
        row = self.top[-1].first()
        return row and row.node


def build(docs: DataFrame, id: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS, now: Mapping[str, Column] | None = None,
          height: int = HEIGHT) -> Manifest:
    """The manifest of ``docs``. ``now`` gives the present value of fields that may have changed since."""
    name = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit(""))  # null before all others
    node = leaf([F.col(c) for c in fields])
    changed = leaf([(now or {}).get(c, F.col(c)) for c in fields])
    leaves = materialise(docs.select(name.alias("tree"), F.col(id).cast("long").alias("id"), node.alias("node"), changed.alias("now")), "leaves")
    leaves = materialise(ranked(leaves, "tree", ["id", "node"]), "places")
    layers = climb(leaves, height)
    roots = layers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    subroots = materialise(ranked(roots, "tree", ["of"]), "subroots")
    return Manifest(leaves, layers, subroots, climb(subroots, height), height)


def verify(manifest: Manifest, id: str = "doc_id") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for every leaf: the root that its present
    digest folds to with the original siblings, and whether that is the root."""
    none = F.array().cast("array<string>")
    apex = manifest.top[-1].select("tree", "pos", none.alias("left"), none.alias("right"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    height = manifest.height
    found = _down([manifest.subroots, *manifest.top], apex, height)
    roots = manifest.subroots.select("of", F.col("pos").alias("__pos"), "node")
    above = found.join(roots, F.col("pos") == F.col("__pos")).select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "left", "right", F.col("node").alias("subroot"), "root")
    above = _down(manifest.layers, above, height)
    out = _beside(manifest.leaves, above, height).applyInArrow(lambda n, a: _verify(n, a, height), OUT)
    return out.select(F.col("id").alias(id), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
