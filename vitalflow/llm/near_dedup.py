"""Near-duplicate documents by minhash with tensored banding.

Two small collections of minhash groups are computed, of `groups` groups of `width` hashes each. A
table's key is a pair of one group from each collection, so 2 * groups * width hashes make
groups**2 tables of 2 * width hashes: about a square root of what independent tables would need. A
pair of sets with likeness s meets in some table unless one collection has no equal group, which
happens with probability under 2 * (1 - s**width)**groups; `groups` is the smallest number that
brings this under `miss` at the threshold.

Documents with equal sets are one node. Of tables with the same members one is kept. In every table the members are held against a few of them,
in rounds, and what is linked becomes one component, until few pairs of members of different
components are left, which are then all compared. Only pairs that can be linked at all are: sets
differ in at least as many shingles as their odd sketches (one bit per hash value, turned over by
every shingle) differ in bits, and two sets that differ in too many cannot be linked. So that filter
loses nothing. All links are confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm import words
from vitalflow.llm.common import numbered_rows
from vitalflow.session import drop_path, fresh_path, staged

WIDTH = 3
MISS = 5e-5
#: Bits of an odd sketch, in words of 64.
SKETCH_WORDS = 8
#: Members of a table that all others are held against in a round. What links to the first of them
#: is merged with it, so more of them in one round would mostly find what is merged already.
LEADS = 2
#: Links found by a round per member still in it, from which another round is worth its cost.
MERGING = 0.01
#: Bits that mark wanted nodes for `_likely`; at 32,768 to a row this is 1 MB, whatever the input.
MARKS = 1 << 23


def group_count(threshold: float, width: int = WIDTH, miss: float = MISS) -> int:
    """Groups per collection so that a pair at the threshold is missed with at most `miss`."""
    return math.ceil(math.log(miss / 2) / math.log(1 - threshold**width))


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    column = batch.column(batch.schema.get_field_index("text"))
    for row, end, data, offsets in words.chunks(column):
        found, bounds = words.words(data, offsets)
        yield row, end, *words.shingles(found, bounds, size)


def signatures(rows: DataFrame, size: int, groups: int, width: int, seed: int) -> DataFrame:
    """(row_key, doc_id, n, set_a, set_b, left, right, odd) of rows (row_key, doc_id, text).

    `n` is the size of the set, `set_a` and `set_b` are two sums over it that stand for it;
    `left` and `right` are the two collections of minhash groups, empty for an empty set; `odd` is
    the odd sketch.
    """
    draw = np.random.default_rng(seed)
    count = 2 * groups * width
    masks = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2)
    factors = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, items, bounds in _sets(batch, size):
                yield _signed(batch.slice(row, end - row), items, bounds)

    def _signed(batch: pa.RecordBatch, items: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        n = np.diff(bounds)
        some = np.flatnonzero(n)
        starts = bounds[:-1][some]
        sums = np.zeros((2, len(n)), dtype=np.uint64)
        grouped = np.zeros((2 * groups, len(some)), dtype=np.uint64)
        if len(some):
            sums[0, some] = np.add.reduceat(items, starts)
            sums[1, some] = np.add.reduceat(words.scrambled(items), starts)
            mixed = np.empty_like(items)
            for k in range(count):
                np.bitwise_xor(items, masks[k], out=mixed)
                np.multiply(mixed, factors[k], out=mixed)
                least = np.minimum.reduceat(mixed, starts)
                grouped[k // width] = words.scrambled(grouped[k // width] + least + np.uint64(k))
        ends = np.concatenate([[0], np.cumsum(np.where(n > 0, groups, 0))]).astype(np.int32)

        def side(part: np.ndarray) -> pa.Array:
            flat = np.ascontiguousarray(part.T).reshape(-1).view(np.int64)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n.astype(np.int64)),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                side(grouped[:groups]),
                side(grouped[groups:]),
                _odd_sketches(items, bounds),
            ],
            ["row_key", "doc_id", "n", "set_a", "set_b", "left", "right", "odd"],
        )

    kinds = "row_key long, doc_id long, n long, set_a long, set_b long, left array<long>, right array<long>, odd array<long>"
    return rows.mapInArrow(work, kinds)


def _odd_sketches(items: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Per set the bits that an odd number of its members have as their leading hash bits."""
    size = 64 * SKETCH_WORDS
    at = (items >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)
    out = np.zeros((len(bounds) - 1, size // 8), dtype=np.uint8)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            out[i] = np.packbits((np.bincount(at[a:b], minlength=size) & 1).astype(np.uint8))
    flat = pa.array(out.reshape(-1).view(np.int64))
    ends = np.arange(0, len(flat) + 1, SKETCH_WORDS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def _may_link(n: Column, m: Column, percent: int) -> Column:
    """False only if the sets differ in too many members to be linked.

    100 * intersection >= percent * union says that the sets differ in at most
    (100 - percent) / (100 + percent) * (n + m) members, and the sketches differ in no more bits.
    """
    apart = F.lit(0)
    for k in range(SKETCH_WORDS):
        apart = apart + F.bit_count(F.col(f"odd{k}_a").bitwiseXOR(F.col(f"odd{k}_b")))
    return apart * (100 + percent) <= (n + m) * (100 - percent)


def full_sets(rows: DataFrame, size: int) -> DataFrame:
    """(node, items) of rows (node, text): the whole set of each, sorted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, items, bounds in _sets(batch, size):
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(items.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), lists], ["node", "items"]
                )

    return rows.select("node", "text").mapInArrow(work, "node long, items array<long>")


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rows` without most of those whose `node` is not in `wanted` (node); all others stay.

    A node has one of `MARKS` bits by its hash. So rows with texts or sets that an exact join would
    drop are not shuffled for it, while no more than the marks reach every task. The join that
    follows is an inner one, as Spark would move a semi join before the marks.
    """
    place = F.pmod(F.xxhash64("node"), F.lit(MARKS)) + 1  # bitmap functions count from 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place).cast("int")
    marks = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_marks"))
    own = F.substring("_marks", F.shiftright(bit, 3) + 1, F.lit(1))
    marked = F.getbit(F.conv(F.hex(own), 16, 10).cast("int"), bit % 8) == 1
    joined = rows.withColumn("_bucket", bucket).join(F.broadcast(marks), "_bucket")
    return joined.filter(marked).drop("_bucket", "_marks")


def _half_key(at: Column, value: Column) -> Column:
    """One of the two halves of a table's key: a minhash group and its place among the groups."""
    return F.xxhash64(at, value)


def _tables(nodes: DataFrame) -> DataFrame:
    """(table_key, place, node, n): one row per node and table in which it could meet another.

    Groups that no other node has cannot make a shared key, so only shared ones are paired. `place`
    is the same in all rows of a table, and smaller for an earlier left and then a later right group.
    """
    half = nodes.select("node", "n", F.posexplode(F.concat("left", "right")).alias("at", "value"))
    half = half.withColumn("half_key", _half_key(F.col("at"), F.col("value")))
    shared = half.groupBy("half_key").agg(F.count("*").alias("c")).filter("c > 1").select("half_key")
    first = F.size("left")
    sides = (
        half.join(shared, "half_key")
        .groupBy("node", "n")
        .agg(F.collect_list(F.struct("at", "half_key")).alias("halves"))  # at most 2 * groups
        .join(nodes.select("node", first.alias("groups")), "node")
    )
    left = F.filter("halves", lambda h: h["at"] < F.col("groups"))
    right = F.filter("halves", lambda h: h["at"] >= F.col("groups"))
    pairs = sides.select("node", "n", "groups", F.explode(left).alias("l"), right.alias("rights"))
    pairs = pairs.select("node", "n", "groups", "l", F.explode("rights").alias("r"))
    key = F.xxhash64("l.half_key", "r.half_key")
    place = F.col("l.at") * 2 * F.col("groups") - F.col("r.at")
    return pairs.select(key.alias("table_key"), place.cast("int").alias("place"), "node", "n")


def _different(tables: DataFrame) -> DataFrame:
    """(table_key) of the tables in which nodes meet, one of those that have the same members.

    Near copies share most of their groups, so most of their tables have the same members, and one
    of these makes all their pairs. It is the one of the first left and the last right group: no
    pair of its members has an earlier or a later one in another of them, as `_pairs_left` needs it.
    Members are the same when their number and 128 bits of their hashes are.
    """
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    meeting = tables.groupBy("table_key").agg(F.count("*").alias("c"), F.min("place").alias("place"), *marks)
    first = F.min(F.struct("place", "table_key")).alias("first")
    kept = meeting.filter("c > 1").groupBy("c", "mark0", "mark1").agg(first)
    return kept.select(F.col("first.table_key").alias("table_key"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = {}
            for name in ("left_items", "right_items"):
                column = batch.column(batch.schema.get_field_index(name))
                data[name] = (column.offsets.to_numpy(), column.values.to_numpy())
            keep = []
            (lo, lv), (ro, rv) = data["left_items"], data["right_items"]
            for i in range(batch.num_rows):
                x, y = lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    left = _likely(sets, pairs.select(F.col("a").alias("node")))
    left = left.select(F.col("node").alias("a"), F.col("items").alias("left_items"))
    right = _likely(sets, pairs.select(F.col("b").alias("node")))
    right = right.select(F.col("node").alias("b"), F.col("items").alias("right_items"))
    together = pairs.select("a", "b").join(left, "a").join(right, "b")
    near = _close(F.size("left_items"), F.size("right_items"), percent)
    return together.filter(near).mapInArrow(work, "a long, b long")


def _close(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be alike enough at all."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each node of `edges` (a, b) reaches.

    Large-star and small-star steps: neighbours are handed to the smallest node seen, until nothing
    changes. Each step is written to the shared folder; nothing but a count comes to the driver.
    """
    edges = staged(edges.filter("a != b").distinct(), name)
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(staged(least, name), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a != b").distinct(), name)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = staged(down.groupBy("a").agg(F.min("b").alias("m")), name)
        small = down.join(lowest, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    own = roots.select(F.col("component").alias("node"), "component").distinct()
    return roots.unionByName(own)


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    width: int = WIDTH,
    miss: float = MISS,
    seed: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): the numbered rows of `docs`, and per row_key its component.

    Words are runs without white space, with A-Z in lower case; a document's set has its distinct
    shingles of `size` words, or all its words as one if they are fewer. Documents are linked when
    100 * intersection >= percent * union; a component is what links reach. Null, empty and blank
    texts have an empty set and stay alone. Of a component the row with the smallest id stays
    (nulls last; among equal ids the first read). Groups have `doc_id`, `n_shingles`,
    `component_id` (the smallest id), `keep_key` and `kept`. Other columns pass inside `row`.
    An empty table gives empty results. Shingles are told apart by 64 bits.
    """
    groups = group_count(percent / 100, width, miss)
    rows, _ = numbered_rows(docs, "near-rows")
    known = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    flat = rows.select(
        "row_key", F.col("row").getField(doc_id).cast("bigint").alias("doc_id"), known.alias("text")
    )
    signed = staged(signatures(flat, size, groups, width, seed), "near-signatures")
    same = ["n", "set_a", "set_b"]
    place = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")
    nodes = staged(
        signed.filter("n > 0").groupBy(*same).agg(
            F.min("row_key").alias("node"), F.min(place).alias("first")
        ),
        "near-nodes",
    )
    alone = signed.select(F.col("row_key").alias("node"), "left", "right").join(
        nodes.select("node", "n"), "node"
    )
    spark = docs.sparkSession
    passing = [fresh_path(spark, name) for name in ("near-alone", "near-tables")]
    tables = _tables(staged(alone, "near-alone", passing[0]))
    tables = staged(tables, "near-tables", passing[1])
    shared = _different(tables)
    members = staged(tables.drop("place").join(shared, "table_key"), "near-members")
    for path in passing:  # room on the disk: nothing reads them any more
        drop_path(spark, path)
    wanted = members.select("node").distinct()
    texts = _likely(flat.withColumnRenamed("row_key", "node"), wanted).join(wanted, "node")
    sets = staged(full_sets(texts, size), "near-sets")

    odd = [F.col("odd")[k].alias(f"odd{k}") for k in range(SKETCH_WORDS)]
    halves = F.transform(F.concat("left", "right"), lambda v, k: _half_key(k, v)).alias("halves")
    sketches = signed.select(F.col("row_key").alias("node"), *odd, halves)
    whole = _meeting_components(members.select("table_key", "node", "n"), sketches, sets, percent)

    rooted = nodes.join(whole, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    rooted = staged(rooted, "near-rooted")
    firsts = rooted.groupBy("component").agg(F.min("first").alias("keep"))
    of_set = staged(rooted.join(firsts, "component").select(*same, "keep"), "near-keep")
    joined = signed.join(of_set, same, "left").withColumn("keep", F.coalesce("keep", place))
    return rows, joined.select(
        "row_key",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("keep.doc_id").alias("component_id"),
        F.col("keep.row_key").alias("keep_key"),
        (F.col("keep.row_key") == F.col("row_key")).alias("kept"),
    )


def _meeting_components(
    members: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """(node, component): what links between nodes that meet in some table join together.

    `members` has (table_key, node, n). In rounds, all members of a table are held against a few of
    them, its leads, and what is linked is merged. A round costs each member a few comparisons,
    however many there are; a large group of near copies becomes one component soon, and tables in
    which only one component is left are done. Once a round merges little, all pairs of members of
    different components that still meet are compared, so no link is lost.
    """
    part: DataFrame | None = None
    compared: DataFrame | None = None
    merging, number = True, 0
    spark = members.sparkSession
    while True:
        placed_at = fresh_path(spark, "near-placed")
        if part is None:  # every node is a component, and every table open
            placed = members.withColumn("component", F.col("node"))
            left = members.count()
        else:
            placed = staged(members.join(part, "node"), "near-placed", placed_at)
            sizes = placed.groupBy("table_key").agg(
                F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("c")
            )
            several = staged(sizes.filter("low != high").select("table_key", "c"), "near-several")
            left = several.agg(F.sum("c")).first()[0]
            placed = placed.join(several.select("table_key"), "table_key")
        if not left:
            return members.select("node", F.col("node").alias("component")).distinct() if part is None else part
        if merging:
            found = _pairs_with_leads(placed, number, sketches, percent)
        else:
            found = _pairs_left(placed, sketches, percent)
        fresh = found if compared is None else found.join(compared, ["a", "b"], "left_anti")
        fresh = staged(fresh, "near-pairs")
        drop_path(spark, placed_at)
        links = staged(_linked(fresh, sets, percent), "near-links")
        if part is None:
            part = members.select("node", F.col("node").alias("component")).distinct()
        part = staged(_merged(part, links), "near-parts")
        if not merging:
            return part
        merging = links.count() >= MERGING * left
        compared = fresh if compared is None else compared.unionByName(fresh)
        number += 1


def _merged(part: DataFrame, links: DataFrame) -> DataFrame:
    """`part` with the components that `links` (a, b) join made one, named by the smallest node."""
    of = part.select(F.col("node").alias("a"), F.col("component").alias("x"))
    of_b = part.select(F.col("node").alias("b"), F.col("component").alias("y"))
    edges = links.join(of, "a").join(of_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(edges).select(F.col("node").alias("component"), F.col("component").alias("to"))
    merged = part.join(joined, "component", "left")
    return merged.select("node", F.coalesce("to", "component").alias("component"))


def _pairs_with_leads(
    rows: DataFrame, number: int, sketches: DataFrame, percent: int
) -> DataFrame:
    """Pairs (a, b) of a table's leads, members drawn by hash, with its members of other components
    that can be linked by size and sketch.

    A pair that meets in many tables is one pair before the sketches are fetched.
    """
    member = F.struct("node", "n", "component")
    names = [f"lead{i}" for i in range(LEADS)]
    drawn = [
        F.min_by(member, F.xxhash64(F.lit(LEADS * number + i), "node")).alias(name)
        for i, name in enumerate(names)
    ]
    leads = rows.groupBy("table_key").agg(*drawn)
    each = rows.join(leads, "table_key").withColumn("lead", F.explode(F.array_distinct(F.array(*names))))
    met = each.filter(
        (F.col("lead.component") != F.col("component")) & _close(F.col("lead.n"), F.col("n"), percent)
    )
    first = F.col("node") < F.col("lead.node")
    pairs = met.select(
        F.least("node", "lead.node").alias("a"),
        F.greatest("node", "lead.node").alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("lead.n")).alias("n_a"),
        F.when(first, F.col("lead.n")).otherwise(F.col("n")).alias("n_b"),
    ).distinct()
    odd = [f"odd{k}" for k in range(SKETCH_WORDS)]
    for side in ("a", "b"):
        own = sketches.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in odd])
        pairs = pairs.join(own, side)
    return pairs.filter(_may_link(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _pairs_left(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of members of different components that can be linked by size and sketch.

    A pair comes out of one of the tables that it meets in only, that of the first and the last
    group which both have. So there are as many rows as pairs, however many tables alike sets share.
    """
    open_rows = staged(rows.select("table_key", "node", "n", "component"), "near-open")
    of_open = open_rows.select("node").distinct()
    wanted = _likely(sketches, of_open).join(of_open, "node")
    wide = staged(open_rows.join(wanted, "node"), "near-sketched")
    columns = ("node", "n", "component", "halves", *[f"odd{k}" for k in range(SKETCH_WORDS)])
    a = wide.select("table_key", *[F.col(c).alias(f"{c}_a") for c in columns])
    b = wide.select("table_key", *[F.col(c).alias(f"{c}_b") for c in columns])
    n, m = F.col("n_a"), F.col("n_b")
    both = F.array_intersect("halves_a", "halves_b")  # in order, so of the first collection and then of the other
    met = a.join(
        b,
        (a["table_key"] == b["table_key"])
        & (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & _close(n, m, percent)
        & _may_link(n, m, percent)
        & (F.xxhash64(F.element_at(both, 1), F.element_at(both, -1)) == a["table_key"]),
    )
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, one of each component, with all their columns."""
    rows, groups = near_groups(docs, **options)
    gone = groups.filter(~F.col("kept")).select("row_key")
    return rows.join(gone, "row_key", "left_anti").select("row.*")
