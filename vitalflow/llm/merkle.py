"""A Merkle manifest of a dataset, in blocks with a van Emde Boas layout.

Every document is a leaf, and per group (language) the leaves in id order carry a tree of arity 8;
the roots of the groups carry one more tree, whose root stands for the dataset. Trees are cut into
aligned blocks of 8^4 leaves. A block is one row of the manifest: its nodes in one array, laid out by
cutting the block at half its height, storing the upper part first and then the lower subtrees from
left to right, each laid out in the same way again. Whatever the size of a cache line or page, a walk
from a leaf to the root touches few of them. The place of a node follows from its depth and index by
arithmetic, which is used both to build a block and to fetch siblings. Roots of blocks are the leaves
of the next layer of blocks, until each tree ends in one.

Documents are sorted by range partitions, so a language with a third of all rows is many blocks in
many tasks; a task holds one block of at most 4,096 digests at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalflow.llm.common import fold_of, worker_cache
from vitalflow.operators.ordered import position
from vitalflow.session import fresh_path

ARITY = 8
#: Levels of a block above its leaves.
HEIGHT = 4
CAPACITY = ARITY**HEIGHT
DIGEST = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_SCHEMA = "tree string, block long, n int, height int, nodes binary, root string"
PATH_SCHEMA = "tree string, block long, above array<string>, subroot string, root string"
PROOF_SCHEMA = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


# ---- one block ---------------------------------------------------------------------------


def tree_size(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes `index` of one depth (the root's is 0) in a tree of `levels` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    bottom = levels - top
    subtree, inside = np.divmod(index, ARITY ** (depth - top))
    return tree_size(top) + subtree * tree_size(bottom) + address(depth - top, inside, bottom)


def _addresses(depth: int, levels: int) -> np.ndarray:
    """The places of all nodes of one depth."""
    known = worker_cache("merkle:addresses")
    if (depth, levels) not in known:
        known[depth, levels] = address(depth, np.arange(ARITY**depth), levels)
    return known[depth, levels]


def _run_length(n: int, below: int) -> int:
    """Nodes that are left of n when so many levels have been joined."""
    for _ in range(below):
        n = -(-n // ARITY)
    return n


@dataclass(frozen=True)
class Block:
    """One aligned subtree with `n` leaves; node rows of 32 bytes, in the layout's order."""

    n: int
    height: int
    nodes: np.ndarray

    @classmethod
    def build(cls, leaves: np.ndarray, height: int) -> Block:
        """The block over rows of digests. A run shorter than the arity is joined as it is."""
        levels, n = height + 1, len(leaves)
        nodes = np.zeros((tree_size(levels), DIGEST), np.uint8)
        nodes[_addresses(height, levels)[:n]] = leaves
        block = cls(n, height, nodes)
        for depth in range(height - 1, -1, -1):
            digests = [sha256(run.encode()).digest() for run in block.runs(depth + 1)]
            rows = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, DIGEST)
            nodes[_addresses(depth, levels)[: len(rows)]] = rows
        return block

    @classmethod
    def load(cls, n: int, height: int, nodes: bytes) -> Block:
        return cls(int(n), int(height), np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST))

    @property
    def root(self) -> str:
        return self.nodes[0].tobytes().hex()

    def runs(self, depth: int) -> list[str]:
        """The digests of one depth as hex text, those of siblings in one string."""
        n = _run_length(self.n, self.height - depth)
        text = self.nodes[_addresses(depth, self.height + 1)[:n]].tobytes().hex()
        width = 2 * DIGEST * ARITY
        return [text[i : i + width] for i in range(0, len(text), width)]

    def siblings(self, leaf: int) -> list[str]:
        """What stands before and after the node, from the leaf's run up to the block's root."""
        out: list[str] = []
        for depth in range(self.height, 0, -1):
            run, levels = leaf // ARITY * ARITY, self.height + 1
            end = min(run + ARITY, _run_length(self.n, self.height - depth))
            places = _addresses(depth, levels)
            before, after = places[run:leaf], places[leaf + 1 : end]
            out += [self.nodes[before].tobytes().hex(), self.nodes[after].tobytes().hex()]
            leaf //= ARITY
        return out


def height_of(block: int, n: int) -> int:
    """Levels of a block with `n` leaves. Only a tree's one block is lower than the others: it
    ends where a single node is left."""
    if block > 0:
        return HEIGHT
    height = 0
    while ARITY**height < n:
        height += 1
    return height


def fold(digest: str, siblings: Sequence[str]) -> str:
    """The root that a digest and what stands before and after it, level by level, lead to."""
    for before, after in zip(siblings[::2], siblings[1::2]):
        digest = sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


# ---- layers of blocks --------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Trees written as blocks below `folder`, one folder per layer; layer 0 holds the leaves."""

    folder: str
    layers: int

    def blocks(self, spark: SparkSession, layer: int) -> DataFrame:
        return spark.read.schema(BLOCK_SCHEMA).parquet(f"{self.folder}/layer-{layer}")

    def roots(self, spark: SparkSession) -> DataFrame:
        """(tree, subroot), one row per tree."""
        ends = [self.blocks(spark, k).filter(_ends_here()) for k in range(self.layers)]
        return reduce(DataFrame.unionByName, ends).select("tree", F.col("root").alias("subroot"))


def _ends_here() -> Column:
    """Whether a block is the last of its tree: a first block that is full may have others beside
    it, and goes on to the next layer, where it stays what it is if it is alone."""
    return (F.col("block") == 0) & (F.col("n") < CAPACITY)


def _build_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("pos")
    number = int(rows["pos"].iloc[0]) // CAPACITY
    leaves = np.frombuffer(b"".join(rows["digest"]), np.uint8).reshape(-1, DIGEST)
    block = Block.build(leaves, height_of(number, len(leaves)))
    return pd.DataFrame(
        {
            "tree": [rows["tree"].iloc[0]], "block": [number], "n": [block.n],
            "height": [block.height], "nodes": [block.nodes.tobytes()], "root": [block.root],
        }
    )


def _block_number() -> Column:
    return F.floor(F.col("pos") / CAPACITY).cast("bigint").alias("block")


def write_forest(leaves: DataFrame, folder: str) -> Forest:
    """Write the trees over (tree, pos, digest), with `pos` from 0 without gaps in each tree."""
    spark, layer = leaves.sparkSession, 0
    while True:
        blocks = (
            leaves.select("tree", "pos", "digest")
            .groupBy("tree", _block_number())
            .applyInPandas(_build_blocks, BLOCK_SCHEMA)
        )
        blocks.write.mode("overwrite").parquet(f"{folder}/layer-{layer}")
        forest = Forest(folder, layer + 1)
        going_on = forest.blocks(spark, layer).filter(~_ends_here())
        if going_on.isEmpty():
            return forest
        leaves = going_on.select("tree", F.col("block").alias("pos"), F.unhex("root").alias("digest"))
        layer += 1


def _paths_below(rows: pd.DataFrame) -> pd.DataFrame:
    """The way up of every leaf of a block, which is the root of a block one layer below."""
    out = []
    for r in rows.itertuples(index=False):
        block = Block.load(r.n, r.height, r.nodes)
        for i in range(block.n):
            above = [*block.siblings(i), *r.above]
            out.append((r.tree, int(r.block) * CAPACITY + i, above, r.subroot, r.top))
    return pd.DataFrame(out, columns=["tree", "block", "above", "subroot", "root"])


def with_paths(forest: Forest, tops: DataFrame) -> DataFrame:
    """The blocks of layer 0 with `above`, the siblings on the way from their root up.

    `tops` has (tree, above, subroot, root): what lies above each tree's own root. Layers are gone
    through from the top; of each, a block's row meets the one row that leads to it.
    """
    spark = tops.sparkSession
    paths: DataFrame | None = None
    for layer in range(forest.layers - 1, -1, -1):
        blocks = forest.blocks(spark, layer).withColumnRenamed("root", "block_root")
        upper = tops.withColumn("block", F.lit(0).cast("bigint"))
        met = blocks.filter(_ends_here()).join(upper, ["tree", "block"])
        if paths is not None:
            met = met.unionByName(blocks.filter(~_ends_here()).join(paths, ["tree", "block"]))
        if layer == 0:
            return met
        renamed = met.withColumnRenamed("root", "top").drop("block_root")
        paths = renamed.mapInPandas(lambda frames: map(_paths_below, frames), PATH_SCHEMA)
    raise ValueError("a forest has at least one layer")


# ---- datasets ----------------------------------------------------------------------------


def encoded(value: Column) -> Column:
    """A value as its length in bytes, a colon and itself; a null as a dash."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]), 256))


def tree_name(group: Column) -> Column:
    """A name per group that is never null and sorts like the groups do, the null one first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


@dataclass(frozen=True)
class Manifest:
    """Documents in place (`rows`: tree, doc_id, digest, forged, pos), the trees of the groups,
    their roots in place (`group_roots`: group, digest, pos), and the tree over these. `root` is
    null for a dataset without documents."""

    rows: DataFrame
    groups: Forest
    group_roots: DataFrame
    top: Forest
    root: str | None

    def tops(self) -> DataFrame:
        """(tree, above, subroot, root): the way from each group's root to the dataset's."""
        spark = self.rows.sparkSession
        nothing = F.array().cast("array<string>")
        whole = F.lit(self.root).cast("string")
        start = self.top.roots(spark).select(
            "tree", nothing.alias("above"), "subroot", whole.alias("root")
        )
        blocks = with_paths(self.top, start).withColumnRenamed("root", "top").drop("block_root")
        paths = blocks.mapInPandas(lambda frames: map(_paths_below, frames), PATH_SCHEMA)
        joined = self.group_roots.join(paths.select(F.col("block").alias("pos"), "above", "root"), "pos")
        subroot = F.lower(F.hex("digest")).alias("subroot")
        return joined.select(F.col("group").alias("tree"), "above", subroot, "root")


def write_manifest(
    docs: DataFrame,
    folder: str | None = None,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    doc_id: str = "doc_id",
    forged: Column | None = None,
    text: str = "text",
) -> Manifest:
    """Write the trees of `docs` below `folder`, a new one in the shared folder if none is given.

    A leaf covers the columns `fields`. Within a group leaves ascend by id, null ids first; rows of
    one id by digest, and rows that are alike altogether in any order, as it makes no difference.
    A null group is a group of its own before all others, the empty one another. A group of one
    document has its leaf as root; a dataset of one group has that group's root. `forged` marks rows
    whose leaf is also made of a text in lower case (A-Z only), as `digest` of a tampered copy.
    Columns not in `fields` play no part, whatever their names.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "manifest")
    columns = {f: F.col(f"`{f}`") for f in fields}
    lowered = {**columns, text: F.translate(F.col(text).cast("string"), UPPER, LOWER)}
    tampered = F.when(
        F.lit(False) if forged is None else forged, leaf_digest([lowered[f] for f in fields])
    )
    slim = docs.select(
        tree_name(F.col(group)).alias("tree"),
        F.col(doc_id).cast("bigint").alias("doc_id"),
        leaf_digest(list(columns.values())).alias("digest"),
        tampered.alias("forged"),
    )
    rows = position(slim, ["tree"], ["doc_id", "digest"], "pos")
    groups = write_forest(rows, f"{folder}/groups")
    roots = groups.roots(spark).select(F.col("tree").alias("group"), F.unhex("subroot").alias("digest"))
    group_roots = position(roots, [], ["group"], "pos")
    top = write_forest(group_roots.withColumn("tree", F.lit("")), f"{folder}/top")
    root = top.roots(spark).first()
    return Manifest(rows, groups, group_roots, top, root.subroot if root else None)


def _proofs_of_block(docs: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
    """Proofs of the documents of one block: siblings in it, then those above it."""
    r = blocks.iloc[0]
    block, above = Block.load(r["n"], r["height"], r["nodes"]), list(r["above"])
    runs = [block.runs(depth) for depth in range(block.height, 0, -1)]
    higher, width, known, out = "".join(above), 2 * DIGEST, {}, []
    for doc_id, digest, forged, pos in docs[["doc_id", "digest", "forged", "pos"]].itertuples(index=False):
        at, leaf = int(pos) % CAPACITY, digest.hex()
        now, proof = leaf if forged is None else forged.hex(), []
        for level in runs:
            run, place = level[at // ARITY], at % ARITY * width
            before, after = run[:place], run[place + width :]
            proof += [before, after]
            now = sha256(f"{before}{now}{after}".encode()).hexdigest()
            at //= ARITY
        if now not in known:  # most documents lead to the same root of the block
            known[now] = fold(now, above)
        digest_of_proof = sha256(("".join(proof) + higher).encode()).hexdigest()
        folded = known[now]
        out.append((doc_id, leaf, r["subroot"], r["root"], digest_of_proof, folded, folded == r["root"]))
    return pd.DataFrame(out, columns=PROOF_SCHEMA.replace(",", "").split()[::2])


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    `folded_root` is worked out from the forged leaf where there is one, else from the leaf itself,
    and the stored siblings; `verified` says whether it is the manifest's root.
    """
    spark = manifest.rows.sparkSession
    if manifest.root is None:
        return spark.createDataFrame([], PROOF_SCHEMA)
    # as text: pandas has no whole numbers beside nulls
    named = manifest.rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    rows = named.withColumn("block", _block_number())
    blocks = with_paths(manifest.groups, manifest.tops()).drop("block_root")
    keys = ["tree", "block"]
    met = rows.groupBy(*keys).cogroup(blocks.groupBy(*keys))
    found = met.applyInPandas(_proofs_of_block, PROOF_SCHEMA.replace("doc_id long", "doc_id string"))
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def siblings_of(spark: SparkSession, forest: Forest, tree: str, pos: int) -> list[str]:
    """The way of one leaf to its tree's root, out of one block of each layer."""
    out: list[str] = []
    for layer in range(forest.layers):
        number, inside = divmod(pos, CAPACITY)
        wanted = (F.col("tree") == tree) & (F.col("block") == number)
        row = forest.blocks(spark, layer).filter(wanted).first()
        if row is None:
            break
        out += Block.load(row.n, row.height, row.nodes).siblings(inside)
        pos = number
    return out


def document_proofs(docs: DataFrame) -> DataFrame:
    """`proofs` of all documents; ids whose crc32 3 divides show a tampered copy (a null id counts
    as empty text)."""
    return proofs(write_manifest(docs, forged=fold_of(F.col("doc_id"), 3) == 0))
