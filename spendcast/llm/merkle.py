"""Merkle manifest of a dataset, with proofs from one multiproof for each block of leaves.

Every row is a leaf, the leaves of one group (a language, say) form a tree, and
the roots of the trees, in the order of their groups, form the tree above them.
A node is the hash of its two children, or of the only one at the end of a level.

Leaves get their places from a range sort that carries digests only. A tree is
built in tiers: each block of 2^BLOCK_BITS nodes is climbed in one task, and the
tops of the blocks are the nodes of the next tier.

Proofs follow the octopus scheme. Each block of leaves works out which nodes all
its paths need and cannot be derived from its own leaves (the least union of
coordinates), these nodes are fetched once for the block by a join, the shared
interior nodes are derived once, and the single proofs are expanded from them in
the block. Nothing but the number of levels and one root reaches the driver.

Defined results: a null value is hashed as ``-``; a row without a group belongs
to the first tree and a row without an id comes first in its tree; rows that
repeat an id are ordered by their leaf hash, equal rows are equal leaves, each
with its own place; a tree of one leaf has that leaf as its root and an empty
proof; an empty table has no root and gives an empty result. Only the named
columns are read, so further columns of any name change nothing. Texts of any
length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.llm.common import release, stored

BLOCK_BITS = 10
PROOF = "array<struct<left: string, right: string>>"


class Manifest(NamedTuple):
    """A dataset's trees.

    leaves: tree, pos, n (leaves of the tree), hash and row (a struct the caller gave).
    nodes: tree, level, idx, n (nodes of the level) and hash; level 0 are the leaves.
    trees: tree, subroot, root and above (the proof of the subroot).
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def leaf_hash(*columns: Column) -> Column:
    """The digest of some values: a null is ``-``, else the count of its UTF-8 bytes, a colon and the value."""
    values = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda node, step: F.sha2(F.concat(F.coalesce(step["left"], F.lit("")), node, F.coalesce(step["right"], F.lit(""))), 256)
    )


def proof_hashes(proof: Column) -> Column:
    """The siblings of a proof, from the leaf to the root and left to right, as one text."""
    return F.array_join(F.flatten(F.transform(proof, lambda step: F.array(step["left"], step["right"]))), "")


def _hash(left: str, right: str = "") -> str:
    return hashlib.sha256((left + right).encode()).hexdigest()


def _climb(nodes: list[str]) -> list[str]:
    """The parents of neighbouring nodes, the first of which has an even index."""
    return [_hash(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]


def _block(pos: str = "pos") -> Column:
    return F.shiftright(pos, BLOCK_BITS)


def _placed(rows: DataFrame, order: Sequence[str], purpose: str) -> DataFrame:
    """Rows (tree, hash, row and what orders them) with their place in the tree and the size n of the tree."""
    rows = stored(rows, purpose)
    # The last key tells equal rows apart, so that any number of them can be cut into ranges.
    keys = ["tree", *order, "hash", "copy"]
    ordered = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select("tree", "hash", "row", F.monotonically_increasing_id().alias("place"))
    ordered = stored(ordered.withColumn("part", F.shiftright("place", 33)), f"{purpose}-sorted")
    # A row for each part and tree; parts are ranges, so there are few more rows than parts or trees.
    counts = ordered.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    return ordered.join(stored(counts, f"{purpose}-counts"), ["tree", "part"]).select(
        "tree", (F.col("place") + F.col("shift")).alias("pos"), "n", "hash", "row"
    )


def _tree_nodes(leaves: DataFrame, purpose: str) -> DataFrame:
    """tree, level, idx, n and hash of every node, leaves included."""
    made_type = "tree string, level int, idx long, n long, hash string"

    def climb(key: tuple, block: pa.Table) -> pa.Table:
        tree, first, base = key[0].as_py(), key[1].as_py() << BLOCK_BITS, key[2].as_py()
        pos = block["pos"].to_numpy()
        at = np.argsort(pos)
        nodes, n = block["hash"].take(pa.array(at)).to_pylist(), block["n"][0].as_py()
        levels, idx, sizes, hashes = [], [], [], []
        for level in range(1, BLOCK_BITS + 1):
            if n == 1:
                break
            nodes, first, n = _climb(nodes), first >> 1, (n + 1) >> 1
            levels += [base + level] * len(nodes)
            idx += range(first, first + len(nodes))
            sizes += [n] * len(nodes)
            hashes += nodes
        return pa.table(
            {
                "tree": pa.array([tree] * len(idx), pa.string()),
                "level": pa.array(levels, pa.int32()),
                "idx": pa.array(idx, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "hash": pa.array(hashes, pa.string()),
            }
        )

    found = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", "hash")
    most, base = leaves.agg(F.max("n")).first()[0] or 0, 0
    tier = found
    while most > 1:
        blocks = tier.where("n > 1").withColumnRenamed("idx", "pos").withColumn("block", _block()).groupBy("tree", "block", "level")
        made = stored(blocks.applyInArrow(climb, made_type), f"{purpose}-nodes")
        found = found.union(made)
        base += BLOCK_BITS
        most = -(-most >> BLOCK_BITS)
        tier = made.where(F.col("level") == base)
    return found


def missing_nodes(pos: np.ndarray, n: int) -> list[np.ndarray]:
    """For each level the nodes that proofs of these leaves need and that do not follow from the leaves."""
    known, found = np.unique(pos), []
    while n > 1:
        beside = known ^ 1
        found.append(np.setdiff1d(beside[beside < n], known, assume_unique=True))
        known, n = np.unique(known >> 1), (n + 1) >> 1
    return found


def _need(key: tuple, block: pa.Table) -> pa.Table:
    found = missing_nodes(block["pos"].to_numpy(), block["n"][0].as_py())
    idx = np.concatenate([*found, np.empty(0, np.int64)])
    level = np.repeat(np.arange(len(found)), [len(f) for f in found])
    return pa.table(
        {
            "tree": pa.array([key[0].as_py()] * len(idx), pa.string()),
            "block": pa.array([key[1].as_py()] * len(idx), pa.int64()),
            "level": pa.array(level, pa.int32()),
            "idx": pa.array(idx, pa.int64()),
        }
    )


def _expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    """The proof of every leaf of a block, from the leaves and the fetched nodes."""
    pos, n = leaves["pos"].to_numpy(), leaves["n"][0].as_py()
    at = np.unique(pos, return_index=True)
    known, hashes = at[0], leaves["hash"].take(pa.array(at[1])).to_pylist()
    given: dict[int, list[tuple[int, str]]] = {}
    for level, i, digest in zip(*(fetched[c].to_pylist() for c in ("level", "idx", "digest"))):
        given.setdefault(level, []).append((i, digest))
    pool: list[str] = []
    lefts, rights, level = [], [], 0
    while n > 1:
        merged = sorted([*zip(known.tolist(), hashes), *given.get(level, ())])
        idx = np.array([i for i, _ in merged], np.int64)
        path = pos >> level
        beside = np.searchsorted(idx, path ^ 1)
        there = (path ^ 1) < n
        odd = (path & 1).astype(bool)
        lefts.append(np.where(odd, beside + len(pool), -1))
        rights.append(np.where(~odd & there, beside + len(pool), -1))
        pool += [digest for _, digest in merged]
        # Interior nodes that several paths share are derived once.
        known, starts = np.unique(idx >> 1, return_index=True)
        digests = [digest for _, digest in merged]
        hashes = [_hash(*digests[a:b]) for a, b in zip(starts, [*starts[1:], len(digests)])]
        n, level = (n + 1) >> 1, level + 1
    texts = pa.array(pool, pa.string())

    def taken(places: list[np.ndarray]) -> pa.Array:
        flat = np.stack(places, axis=1).reshape(-1) if places else np.empty(0, np.int64)
        return texts.take(pa.array(np.maximum(flat, 0), pa.int64(), mask=flat < 0))

    steps = pa.StructArray.from_arrays([taken(lefts), taken(rights)], ["left", "right"])
    offsets = pa.array(np.arange(len(pos) + 1) * level, pa.int32())
    kept = leaves.select(["tree", "hash", "row"])
    return kept.append_column("proof", pa.ListArray.from_arrays(offsets, steps))


def _proofs(leaves: DataFrame, nodes: DataFrame, purpose: str) -> DataFrame:
    """tree, hash, row and proof (up to the root of the tree) of the given leaves, which may be some or all."""
    leaves = leaves.withColumn("block", _block())
    need = leaves.select("tree", "block", "pos", "n").groupBy("tree", "block").applyInArrow(_need, "tree string, block long, level int, idx long")
    need = stored(need, f"{purpose}-missing")
    lowest = need.agg(F.min("level")).first()[0]
    # Whole blocks need nothing below their tops, so the nodes of lower levels are not read.
    fetched = need.join(nodes.where(F.col("level") >= F.lit(lowest)), ["tree", "level", "idx"])
    fetched = fetched.select("tree", "block", "level", "idx", F.col("hash").alias("digest"))
    row_type = leaves.schema["row"].dataType.simpleString()
    return (
        leaves.groupBy("tree", "block")
        .cogroup(fetched.groupBy("tree", "block"))
        .applyInArrow(_expand, f"tree string, hash string, row {row_type}, proof {PROOF}")
    )


def build_manifest(rows: DataFrame, order: Sequence[str], purpose: str = "merkle") -> Manifest:
    """The trees of rows with the columns group (string), hash (hexadecimal), row (a struct to carry) and those that order a group."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")).alias("tree")  # no group comes first
    leaves = _placed(rows.select(tree, *order, "hash", "row"), order, purpose)
    nodes = _tree_nodes(leaves, purpose)
    tops = stored(nodes.where("n = 1").select("tree", "hash"), f"{purpose}-tops")
    members = _placed(
        tops.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "hash", F.struct(F.col("tree").alias("member")).alias("row")),
        ["member"],
        f"{purpose}-top",
    )
    above = _tree_nodes(members, f"{purpose}-top")
    root = above.where("n = 1").select("hash").first()
    trees = _proofs(members, above, f"{purpose}-top").select(
        F.col("row.member").alias("tree"),
        F.col("hash").alias("subroot"),
        F.lit(root["hash"] if root else None).cast("string").alias("root"),
        F.col("proof").alias("above"),
    )
    trees = stored(trees, f"{purpose}-trees")
    release(rows.sparkSession)
    return Manifest(leaves, nodes, trees)


def prove(manifest: Manifest, leaves: DataFrame | None = None, purpose: str = "merkle") -> DataFrame:
    """hash, row, subroot, root and proof (from the leaf to the root) of every leaf, or of some rows of the manifest's leaves."""
    proofs = _proofs(manifest.leaves if leaves is None else leaves, manifest.nodes, purpose)
    return proofs.join(manifest.trees, "tree").select("hash", "row", "subroot", "root", F.concat("proof", "above").alias("proof"))


def audit(documents: DataFrame, group: str, order: str, columns: Sequence[str], claimed: dict[str, Column]) -> DataFrame:
    """Leaf and proof of every document, and the root that its claimed values lead to.

    ``claimed`` replaces values of some columns by what someone says they are.
    Gives the order column, leaf, subroot, root, proof, folded_root and verified.
    """
    as_claimed = leaf_hash(*(claimed.get(c, F.col(c)) for c in columns))
    rows = documents.select(
        F.col(group).cast("string").alias("group"),
        F.col(order).alias("key"),
        leaf_hash(*map(F.col, columns)).alias("hash"),
        F.struct(F.col(order).alias("key"), as_claimed.alias("claimed")).alias("row"),
    )
    proved = prove(build_manifest(rows, ["key"]))
    folded = proved.withColumn("folded_root", fold(F.col("row.claimed"), F.col("proof")))
    return folded.select(
        F.col("row.key").alias(order),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        "proof",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
