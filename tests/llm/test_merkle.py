"""Merkle manifests against a plain tree over lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import merkle
from vitalflow.llm.common import documents


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h("".join(parts))


def tree_by_hand(leaves):
    """The root, and per leaf what stands before and after it on each level."""
    level, at, ways = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for way, i in zip(ways, at):
            run = i // 8 * 8
            way.append((level[run:i], level[i + 1 : run + 8]))
        level = [h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], ways


def fold_by_hand(leaf, way):
    for before, after in way:
        leaf = h("".join(before) + leaf + "".join(after))
    return leaf


def manifest_by_hand(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        ordered = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        trees[g] = (ordered, *tree_by_hand([leaf_by_hand(r) for r in ordered]))
    root, tops = tree_by_hand([trees[g][1] for g in names])
    out = []
    for g, top in zip(names, tops):
        ordered, subroot, ways = trees[g]
        for row, way in zip(ordered, ways):
            way = way + top
            proof = h("".join("".join(before + after) for before, after in way))
            tampered = zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0
            folded = fold_by_hand(leaf_by_hand(row, lower=tampered), way)
            out.append((row[0], leaf_by_hand(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def shown(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", range(1, 6))
def test_addresses_fill_the_array(levels):
    places = [merkle.address(d, np.arange(8**d), levels) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.tree_size(levels)))
    assert places[0].tolist() == [0]


def test_subtrees_below_half_height_lie_together():
    """Layout of five levels: the two upper ones, then 64 subtrees of three levels, whole."""
    top, below = merkle.tree_size(2), merkle.tree_size(3)
    assert all(merkle.address(d, np.arange(8**d), 5).max() < top for d in (0, 1))
    for depth in (2, 3, 4):
        index = np.arange(8**depth)
        assert ((merkle.address(depth, index, 5) - top) // below == index // 8 ** (depth - 2)).all()


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 100, 513, 4_096])
def test_a_block_is_the_plain_tree(n):
    leaves = [h(str(i)) for i in range(n)]
    rows = np.frombuffer(bytes.fromhex("".join(leaves)), np.uint8).reshape(-1, 32)
    block = merkle.Block.build(rows, merkle.height_of(0, n))
    root, ways = tree_by_hand(leaves)
    assert block.root == root
    back = merkle.Block.load(n, block.height, block.nodes.tobytes())
    for i in random.Random(n).sample(range(n), min(n, 40)):
        siblings = back.siblings(i)
        assert siblings == ["".join(part) for pair in ways[i] for part in pair]
        assert merkle.fold(leaves[i], siblings) == root


def odd_rows():
    rng = random.Random(5)
    langs = ["en"] * 6 + ["de", "", None, "é", "z", "Z", "=", "-"]
    rows = [
        (i, rng.choice(["s", None, ""]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", f"Text Ä {i}"]))
        for i in range(400)
    ]
    rows += [(None, "a", "en", 1, "A"), (None, "a", None, 1, "A"), (7, "x", "en", 1, "B"), (7, "x", "en", 1, "B")]
    return rows + [(900, "s", "only", 3, "LONG " * 100_000), (-3, None, "én", None, "3:abc-")]


def test_odd_rows_against_the_plain_tree(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    assert shown(merkle.document_proofs(frame)) == manifest_by_hand(rows)
    clash = frame.withColumn("tree", F.lit(1)).withColumn("pos", F.lit("p")).withColumn("digest", F.lit(0))
    assert shown(merkle.document_proofs(clash.repartition(5))) == manifest_by_hand(rows)


def test_many_layers_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "CAPACITY", 8)
    for n in (64, 65, 200):
        rows = [(i, "s", ["en", "de", "x"][i % 10 == 0] if i else "x", i, f"T{i}") for i in range(n)]
        frame = spark.createDataFrame(rows, SCHEMA)
        assert shown(merkle.document_proofs(frame)) == manifest_by_hand(rows)


def test_whole_table_and_stored_siblings(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    manifest = merkle.write_manifest(docs)
    place = manifest.rows.filter(F.col("tree") == "=en").orderBy("pos").collect()[7]
    siblings = merkle.siblings_of(spark, manifest.groups, "=en", 7)
    roots = {r.tree: r.subroot for r in manifest.groups.roots(spark).collect()}
    assert merkle.fold(place.digest.hex(), siblings) == roots["=en"]
    want = manifest_by_hand(rows)
    assert shown(merkle.document_proofs(docs)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_nothing_and_one(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.document_proofs(none).count() == 0
    one = [(1, "s", "en", 2, None)]
    assert shown(merkle.document_proofs(spark.createDataFrame(one, SCHEMA))) == manifest_by_hand(one)
    assert shown(merkle.document_proofs(spark.createDataFrame(one, SCHEMA)))[0][4] == h("")
