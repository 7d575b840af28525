"""Filter audits and shards: small cases, brute force and laws of chance."""

import math
import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalflow.llm import filter_audit, sharding
from vitalflow.llm.common import documents

# ---- filter audit ------------------------------------------------------------------------


def steps_by_hand(names, failing):
    """Steps of every order for a list of (set of failed filters, good, toxic)."""
    out, over = {}, Counter()
    for order in permutations(names):
        rest = failing
        for step, name in enumerate(order, 1):
            gone = [r for r in rest if name in r[0]]
            rest = [r for r in rest if name not in r[0]]
            over[name] += len(gone)
            out["".join(order), step] = [
                len(rest),
                len(gone),
                sum(name in r[0] for r in failing) - len(gone),
                sum(r[0] == {name} for r in failing),
                sum(r[1] for r in gone),
                sum(r[2] for r in gone),
            ]
    return {(order, step): (*v, over[order[step - 1]]) for (order, step), v in out.items()}


@pytest.mark.parametrize("n", range(1, 6))
def test_neighbour_swaps_visit_every_order_once(n):
    order = list(range(n))
    seen = {tuple(order)}
    for place in filter_audit.neighbour_swaps(n):
        order[place], order[place + 1] = order[place + 1], order[place]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n)


@pytest.mark.parametrize("seed", range(4))
def test_diagram_steps_equal_sets_of_failures(seed):
    rng = random.Random(seed)
    names = "ABCD"
    failing = [
        ({c for c in names if rng.random() < 0.4}, rng.random() < 0.3, rng.random() < 0.2)
        for _ in range(60 * seed)
    ]
    masks = Counter()
    for fails, good, toxic in failing:
        mask = sum(1 << names.index(c) for c in fails)
        masks[mask] = tuple(a + b for a, b in zip(masks[mask] or (0, 0, 0), (1, good, toxic)))
    rows = filter_audit.steps_of_orders(names, masks)
    assert {(r[0], r[1]): r[2:] for r in rows} == steps_by_hand(names, failing)


def test_a_swap_keeps_the_diagram_reduced():
    masks = {m: (1 + m % 3, 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram(range(5), masks, 3)
    before, weight = diagram.size(), diagram.root.weight
    for place in filter_audit.neighbour_swaps(5):
        diagram.swap(place)
        assert diagram.size() == filter_audit.Diagram(diagram.order, masks, 3).size()
        assert diagram.root.weight == weight
    assert before < 32 + 31


def test_audit_of_odd_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(100_000))
    rows = [
        (1, "de", "short", 0), (2, None, "short", 0), (2, "", "short", 0), (None, "en", "short", 0),
        (None, "en", None, 0), (3, "en", "", 0), (4, "en", long_text, 0), (5, "en", "a " * 300, 0),
        (6, "en", "ABC " * 10, 0), (7, "en", "x | y", 0),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string, mask int")
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int"
    )
    got = filter_audit.audit_documents(frame, labels).collect()
    failing = {
        "de": [({"A"}, 1, 0)],
        "": [({"A", "E"}, 1, 1)] * 2,
        "en": [
            ({"A", "E"}, 0, 0), ({"A", "E"}, 0, 0), ({"A"}, 0, 0), (set(), 0, 0), ({"B"}, 0, 0),
            ({"A", "B", "C"}, 0, 0), ({"A", "D"}, 0, 0),
        ],
    }
    assert len(got) == 3 * 600
    for part, rows in failing.items():
        want = steps_by_hand("ABCDE", rows)
        assert {(r.filter_order, r.step): tuple(r)[3:] for r in got if r.part == part} == want


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", None)], docs.schema)
    assert filter_audit.audit_documents(one, labels).count() == 600
    with pytest.raises(ValueError):
        filter_audit.audit(docs, [])


# ---- shards ------------------------------------------------------------------------------


def chance(good, bad, sample, k):
    def ways(n, k):
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    if not 0 <= k <= min(good, sample) or sample - k > bad:
        return 0.0
    return math.exp(ways(good, k) + ways(bad, sample - k) - ways(good + bad, sample))


@pytest.mark.parametrize(
    "good,bad,sample", [(5, 7, 6), (900, 300, 700), (300, 500, 400), (5_000, 9_000, 3_000), (400, 10_000, 9_000)]
)
def test_counts_follow_the_hypergeometric_law(spark, good, bad, sample):
    n = 20_000
    drawn = sharding.hypergeometric(F.lit(good), F.lit(bad), F.lit(sample), F.col("id"))
    times = Counter({r.k: r.n for r in spark.range(n).groupBy(drawn.alias("k")).agg(F.count("*").alias("n")).collect()})
    wanted = {k: n * chance(good, bad, sample, k) for k in range(min(good, sample) + 1)}
    assert all(wanted[k] > 0 for k in times)
    common = [k for k, w in wanted.items() if w >= 5]
    chi = sum((times[k] - wanted[k]) ** 2 / wanted[k] for k in common)
    assert chi < len(common) + 5 * math.sqrt(2 * len(common)) + 5


def test_certain_counts(spark):
    cases = {(0, 4, 3): 0, (4, 0, 3): 3, (0, 0, 0): 0, (9, 5, 14): 9, (9, 5, 0): 0, (700, 0, 400): 400}
    frame = spark.createDataFrame([(*c, want) for c, want in cases.items()], "g int, b int, s int, want long")
    got = frame.select(sharding.hypergeometric(F.col("g"), F.col("b"), F.col("s"), F.lit(1)).alias("k"), "want")
    assert all(r.k == r.want for r in got.collect())


def test_large_counts_have_the_right_middle_and_spread(spark):
    good, bad, sample = 10**10, 15 * 10**10, 8 * 10**10
    drawn = sharding.hypergeometric(F.lit(good), F.lit(bad), F.lit(sample), F.col("id"))
    mean, spread = spark.range(4_000).agg(F.avg(drawn - good // 2), F.stddev(drawn)).first()
    assert abs(mean) < 5 * 48_412 / math.sqrt(4_000)
    assert spread == pytest.approx(48_412, rel=0.06)


def test_matrix_has_the_margins_of_partitions_and_shards(spark):
    sizes = [0, 1, 700, 3, 0, 12, 5_000, 44, 9, 1, 1, 2, 350] * 7
    counts = spark.createDataFrame([(3 * i, n) for i, n in enumerate(sizes)], "part int, n int")
    shards = sharding.shard_sizes(sum(sizes), 5)
    got = {r.part: r.counts for r in sharding.communication_matrix(counts, shards).collect()}
    assert [sum(got[3 * i]) for i in range(len(sizes))] == sizes
    assert np.sum(list(got.values()), axis=0).tolist() == shards
    assert min(min(v) for v in got.values()) == 0


def test_every_row_gets_one_gapless_slot(spark):
    rows = [(i % 50 or None, "x" if i % 3 else None, "k", i, "a.b") for i in range(1_003)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot long, `a.b` string")
    out = sharding.shard_rows(frame.repartition(9), shards=7)
    assert sorted(out.columns) == ["a.b", "doc_id", "shard", "slot", "text"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    slots = {j: sorted(r.slot for r in got if r["shard"] == j) for j in range(7)}
    assert [len(slots[j]) for j in range(7)] == sharding.shard_sizes(1_003, 7)
    assert all(s == list(range(len(s))) for s in slots.values())


def test_shards_are_uniform(spark):
    """Where neighbours of one partition go, over many seeds: every shard and half equally often."""
    frame = spark.range(40).repartition(4)
    places, together = Counter(), 0
    for seed in range(12):
        got = {r.id: (r["shard"], r.slot) for r in sharding.shard_rows(frame, 4, seed).collect()}
        places.update(s for s, _ in got.values())
        together += sum(got[i][0] == got[i + 1][0] for i in range(39))
        assert sorted(got.values()) == [(j, k) for j in range(4) for k in range(10)]
    assert set(places.values()) == {120}
    assert abs(together - 12 * 39 * 9 / 39) < 5 * math.sqrt(12 * 39 * 0.23 * 0.77)


def test_document_shards(spark, sf_dir):
    docs = documents(spark, sf_dir)
    got = {r.doc_id: r for r in sharding.document_shards(docs).collect()}
    again = {r.doc_id: r for r in sharding.document_shards(docs).collect()}
    assert got == again
    for doc_id, text in docs.select("doc_id", "text").collect():
        data = (text or "").encode()
        assert (got[doc_id].size, got[doc_id].text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert got[doc_id].law == "rows" and got[doc_id].grown_shard is None
    assert sharding.document_shards(docs.limit(0)).count() == 0


def test_written_shards_are_in_slot_order(spark):
    path = sharding.write_shards(spark.range(500).repartition(3), shards=4)
    back = spark.read.parquet(path)
    assert Counter(r["shard"] for r in back.collect()) == Counter({j: 125 for j in range(4)})
    assert back.select("id").distinct().count() == 500
