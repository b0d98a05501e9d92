"""Merkle manifest of a dataset: one tree per group, one tree over the groups, folded proofs per row.

A leaf is the SHA-256 of a row's fields. A group's leaves stand in the order of their key; runs of `arity`
nodes become the hash of their joined hex digests until one node, the group's subroot, remains. The
subroots, in the order of the groups, become the root in the same way.

A parent keeps a copy of its running hash before each child slot. To put another child into a slot, the copy of
that slot goes on with the replacement and the siblings to its right; what stands to the left is not hashed
again. So a row is checked against the root, or the root of a changed row is found, from its leaf and its path
alone.

At scale: leaves are hashed by Spark, ranged along (group, key) and numbered densely, so a group that holds
most rows is cut like any other. A tree is built in blocks of `arity ** height` nodes: one task per block, and
the next level up has one node per block, until one node is left. Paths then come down the same levels, one row
per block, and meet the block's rows once; a block's upper parents are made once and serve all of its rows.

Defined results: a null field is `-`, any other its length in bytes, a colon and the value, so an empty text is
not a null. A null group is a group of its own and comes first; in it, null keys come first; rows with equal
keys stand in the order of their leaves, so repeated rows are leaves of their own and the root does not depend on
how rows are stored. A group with one row has its leaf as subroot. An empty table gives no rows. Other columns
are left out, whatever their names. Long texts are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.order import row_index
from millrace.operators.skew import join_unique
from millrace.session import store

ARITY = 2
HEIGHT = 12  # levels that one task builds: 4,096 nodes of a binary tree
ROWS_PER_RANGE = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class Parent:
    """A node with its children and the running hash before each of them."""

    def __init__(self, children: list[bytes]):
        self.children, self.before = children, []
        running = hashlib.sha256()
        for child in children:
            self.before.append(running.copy())
            running.update(child)
        self.digest = running.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """The digest with another child in one slot: from the state before it on."""
        running = self.before[slot].copy()
        running.update(replacement)
        for sibling in self.children[slot + 1 :]:
            running.update(sibling)
        return running.hexdigest().encode()

    def others(self, slot: int) -> list[bytes]:
        return self.children[:slot] + self.children[slot + 1 :]


def levels_of(nodes: list[bytes], arity: int, height: int | None) -> list[list[Parent]]:
    """The parents of each level above `nodes`: `height` levels, or (None) until one node is left."""
    levels = []
    while len(nodes) > 1 if height is None else len(levels) < height:
        parents = [Parent(nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        levels.append(parents)
        nodes = [p.digest for p in parents]
    return levels


def _top(nodes: list[bytes], levels: list[list[Parent]]) -> bytes:
    return levels[-1][0].digest if levels else nodes[0]


def _walk(at: int, levels: list[list[Parent]], arity: int) -> Iterator[tuple[Parent, int]]:
    """The parents above a node and the slots that the way up takes."""
    for level in levels:
        at, slot = divmod(at, arity)
        yield level[at], slot


# A path is text, `slot:other,other` per level, lowest first, levels joined by semicolons.


def _path_text(way: Iterator[tuple[Parent, int]]) -> list[str]:
    return [f"{slot}:{','.join(x.decode() for x in parent.others(slot))}" for parent, slot in way]


def _path_parents(path: str, node: bytes) -> list[tuple[Parent, int]]:
    out = []
    for step in filter(None, path.split(";")):
        slot, _, others = step.partition(":")
        children = [x.encode() for x in others.split(",") if x]
        children.insert(int(slot), node)
        out.append((Parent(children), int(slot)))
        node = out[-1][0].digest
    return out


# ---------------------------------------------------------------- leaves


def leaf_digest(fields: list[Column]) -> Column:
    parts = [F.when(f.isNull(), "-").otherwise(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string"))) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame) -> DataFrame:
    """tree (0, 1, ... in the order of the groups), pos (place in the group), n (rows of the group), id, leaf, given."""
    keys = ["grp", "id", "leaf", "row"]
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = row_index(rows, keys, "place", buckets=max(1, -(-rows.count() // ROWS_PER_RANGE)))
    groups = store(placed.groupBy("grp").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    groups = row_index(groups, ["start"], "tree", buckets=max(1, -(-groups.count() // ROWS_PER_RANGE)))
    groups = store(groups.withColumnRenamed("grp", "of"), "merkle-trees")
    joined = join_unique(placed, groups, {"grp": "of"}, null_safe=True)
    return store(joined.select("tree", (F.col("place") - F.col("start")).alias("pos"), "n", "id", "leaf", "given"), "merkle-places")


# ---------------------------------------------------------------- up and down


def _sorted_nodes(table: pa.Table) -> tuple[pa.Table, list[bytes], int]:
    table = table.sort_by("pos")
    return table, [x.encode() for x in table["hash"].to_pylist()], table["n"][0].as_py()


def _height(n: int, arity: int, height: int) -> int | None:
    """All levels of a block, unless the block is the whole tree."""
    return height if n > arity**height else None


def _raised(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """One node per block: columns tree, pos, n, hash."""
    width = arity**height

    def build(table: pa.Table) -> pa.Table:
        table, hashes, n = _sorted_nodes(table)
        top = _top(hashes, levels_of(hashes, arity, _height(n, arity, height)))
        return pa.table({
            "tree": table["tree"].slice(0, 1), "pos": pa.array([table["pos"][0].as_py() // width], pa.int64()),
            "n": pa.array([-(-n // width)], pa.int64()), "hash": pa.array([top.decode()]),
        })

    blocks = nodes.select("tree", "pos", "n", "hash").groupBy("tree", F.floor(F.col("pos") / F.lit(width)).alias("block"))
    return store(blocks.applyInArrow(build, "tree long, pos long, n long, hash string"), "merkle-nodes")


def _climb(nodes: DataFrame, arity: int, height: int) -> list[DataFrame]:
    """The nodes and those of the blocks above them, until each tree has one node."""
    out = [nodes]
    while out[-1].agg(F.max("n")).first()[0] > 1:
        out.append(_raised(out[-1], arity, height))
    return out


def _met(nodes: DataFrame, paths: DataFrame, function: Callable, schema: str, width: int) -> DataFrame:
    """A function of each block's nodes and of the path of the block."""
    block = F.floor(F.col("pos") / F.lit(width)).alias("block")
    return nodes.groupBy("tree", block).cogroup(paths.groupBy("tree", F.col("pos").alias("block"))).applyInArrow(function, schema)


def _descended(nodes: DataFrame, paths: DataFrame, arity: int, height: int) -> DataFrame:
    """The path of each node to the root, from the paths of the blocks: columns tree, pos, subroot, path."""

    def extend(table: pa.Table, above: pa.Table) -> pa.Table:
        table, hashes, n = _sorted_nodes(table)
        levels, upper = levels_of(hashes, arity, _height(n, arity, height)), above["path"][0].as_py()
        steps = [";".join(_path_text(_walk(i, levels, arity)) + ([upper] if upper else [])) for i in range(len(hashes))]
        subroot = pa.array([above["subroot"][0].as_py()] * len(hashes), pa.string())
        return pa.table({"tree": table["tree"], "pos": table["pos"], "subroot": subroot, "path": pa.array(steps, pa.string())})

    found = _met(nodes, paths, extend, "tree long, pos long, subroot string, path string", arity**height)
    return store(found, "merkle-paths")


def _folded(rows: DataFrame, paths: DataFrame, root: str, kind: str, arity: int, height: int) -> DataFrame:

    def fold(table: pa.Table, above: pa.Table) -> pa.Table:
        table, hashes, n = _sorted_nodes(table)
        levels = levels_of(hashes, arity, _height(n, arity, height))
        upper = _path_parents(above["path"][0].as_py(), _top(hashes, levels))
        rest = [x for parent, slot in upper for x in parent.others(slot)]
        proofs, roots = [], []
        for i, given in enumerate(table["given"].to_pylist()):
            node, siblings = given.encode(), []
            for parent, slot in _walk(i, levels, arity):
                siblings += parent.others(slot)
                node = parent.fold(slot, node)
            for parent, slot in upper:
                node = parent.fold(slot, node)
            proofs.append(digest(*siblings, *rest).decode())
            roots.append(node.decode())
        same = len(hashes)
        return pa.table({
            "id": table["id"], "leaf": table["hash"], "subroot": pa.array([above["subroot"][0].as_py()] * same, pa.string()),
            "root": pa.array([root] * same, pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(roots, pa.string()),
        })

    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _met(rows, paths, fold, schema, arity**height)


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
    given: dict[str, Column] | None = None, arity: int = ARITY, height: int = HEIGHT,
) -> DataFrame:
    """One row per row of `docs`: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    `given` holds what is found in place of a field when the rows are checked (a column of `docs`): the leaf of
    these values is folded with the siblings of the original, and a row is verified if that gives the root.
    """
    given = given or {}
    kept = [F.col(f) for f in fields]
    seen = [given.get(f, F.col(f)) for f in fields]
    rows = docs.select(
        F.col(key).alias("id"), F.col(group).cast("string").alias("grp"), leaf_digest(kept).alias("leaf"),
        (leaf_digest(seen) if given else F.lit(None).cast("string")).alias("given"),
    ).withColumn("given", F.coalesce("given", "leaf"))
    kind = docs.schema[key].dataType.simpleString()
    places = _numbered(rows).withColumnRenamed("leaf", "hash")
    if places.isEmpty():
        none = f"{key} {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], none)
    own = _climb(places, arity, height)
    subroots = own[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "hash")
    over = _climb(subroots.withColumn("n", F.lit(own[-1].count())), arity, height)
    root = over[-1].first()["hash"]
    paths = over[-1].select("tree", "pos", F.lit(None).cast("string").alias("subroot"), F.lit("").alias("path"))
    for nodes in reversed(over[:-1]):
        paths = _descended(nodes, paths, arity, height)
    named = own[-1].select(F.col("tree").alias("of"), F.col("hash").alias("top"))
    paths = paths.join(named, F.col("pos") == F.col("of")).select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("top").alias("subroot"), "path")
    for nodes in reversed(own[1:-1]):
        paths = _descended(nodes, paths, arity, height)
    folded = _folded(places, paths, root, kind, arity, height)
    return folded.select(
        F.col("id").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
