"""How filters of documents interact, read off decision diagrams of their failure masks.

Spark reduces the documents to one row per part and failure mask: how many documents fail just
those filters, and how many of them are labelled good or toxic. From the masks of one part a
count-weighted decision diagram is built: a level per filter, one arc for documents that pass it
and one for those that fail, equal subdiagrams shared, and at every node the weight of all
documents below it. Filters are applied in the order of the levels, so the path of passes only,
from the root down, holds what each step keeps, and the failing arc beside it what the step
removes. Other orders come from swaps of neighbouring levels, which rebuild those two levels and
nothing else; a tour through all orders needs one swap for each.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import count
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import SPACE, text_of

#: Filters whose orders are all visited: eight have 40,320.
MOST_FILTERS = 8
STEP_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)

Weight = tuple[int, ...]


# ---- diagrams ----------------------------------------------------------------------------


@dataclass(eq=False, slots=True)
class Node:
    """Documents that agree on the levels above: those that pass this level's filter go on to
    `passing`, the others to `failing`; `weight` counts both. A node without arcs is terminal."""

    weight: Weight
    passing: Node | None = None
    failing: Node | None = None


class Diagram:
    """A reduced decision diagram with one level per filter, in the order `order`.

    No level is skipped, so that a node's weight is the sum of its two children's.
    """

    def __init__(self, order: Sequence[int], masks: Mapping[int, Weight], width: int):
        self.order = list(order)
        self._terminals: dict[Weight, Node] = {}
        self._levels: list[dict[tuple[int, int], Node]] = [{} for _ in order]
        self._none = (0,) * width
        self.root = self._built(0, 0, masks)

    def _built(self, level: int, mask: int, masks: Mapping[int, Weight]) -> Node:
        if level == len(self.order):
            weight = masks.get(mask, self._none)
            return self._terminals.setdefault(weight, Node(weight))
        failed = mask | 1 << self.order[level]
        return self._node(
            level, self._built(level + 1, mask, masks), self._built(level + 1, failed, masks)
        )

    def _node(self, level: int, passing: Node, failing: Node) -> Node:
        """The one node of the level with these arcs."""
        known = self._levels[level]
        key = (id(passing), id(failing))
        if key not in known:
            weight = tuple(a + b for a, b in zip(passing.weight, failing.weight))
            known[key] = Node(weight, passing, failing)
        return known[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of `level` and the level below it.

        Nodes of the upper level stand for the same documents before and after, so they stay
        what they are to the levels above; only their arcs change. The lower level is made anew.
        """
        upper = list(self._levels[level].values())
        self._levels[level], self._levels[level + 1] = {}, {}
        for node in upper:
            one, other = node.passing, node.failing
            node.passing = self._node(level + 1, one.passing, other.passing)
            node.failing = self._node(level + 1, one.failing, other.failing)
            self._levels[level][id(node.passing), id(node.failing)] = node
        order = self.order
        order[level], order[level + 1] = order[level + 1], order[level]

    def passes(self) -> Iterator[Node]:
        """The nodes of the path of passes only, from the root to its terminal."""
        node = self.root
        while node is not None:
            yield node
            node = node.passing

    def size(self) -> int:
        return len(self._terminals) + sum(map(len, self._levels))


def neighbour_swaps(n: int) -> Iterator[int]:
    """Places of the swaps of neighbours that lead through all orders of `n` things, each once.

    The last thing moves through an order of the others from end to end, then the others make
    their next swap, shifted by one where the last thing stands in front of them.
    """
    if n < 2:
        return
    others = neighbour_swaps(n - 1)
    for turn in count():
        down = turn % 2 == 0
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(others, None)
        if step is None:
            return
        yield step + 1 if down else step


def steps_of_orders(names: Sequence[str], masks: Mapping[int, Weight]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of
    every order of the filters and step; bit i of a mask says that names[i] fails, a weight counts
    (documents, good ones, toxic ones)."""
    n = len(names)
    diagram = Diagram(range(n), masks, 3)
    fails = [sum(w[0] for m, w in masks.items() if m >> i & 1) for i in range(n)]
    alone = [masks.get(1 << i, (0,))[0] for i in range(n)]
    over_orders = [0] * n
    rows = []
    swaps = neighbour_swaps(n)
    for _ in range(factorial(n)):
        order = "".join(names[i] for i in diagram.order)
        path = list(diagram.passes())
        for step, (node, after) in enumerate(zip(path, path[1:])):
            i = diagram.order[step]
            removed, good, toxic = node.failing.weight
            over_orders[i] += removed
            row = (order, step + 1, after.weight[0], removed, fails[i] - removed, alone[i], good, toxic)
            rows.append((i, row))
        if (place := next(swaps, None)) is not None:
            diagram.swap(place)
    return [(*row, over_orders[i]) for i, row in rows]


# ---- documents to masks ------------------------------------------------------------------


def quality_filters(text: Column, words_at_least: int = 200) -> dict[str, Column]:
    """Failure conditions of four filters on whole texts: too short, words that repeat, capitals,
    signs of markup."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < words_at_least,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals * 100 > F.length(text) * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def failure_masks(
    docs: DataFrame,
    labels: DataFrame,
    conditions: Mapping[str, Column],
    part: str = "lang",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of filters that they fail.

    Bit i of `mask` is the i-th of `conditions`, which look at the text alone. The next bit says
    that a document of smaller id, in whatever part, has the same text. A null text is empty, a
    null part the empty string, a null condition passes. A document with a null id comes after
    all others; documents of one id and text are no copies of each other. Several label rows of
    an id count as good or toxic if one of them says so; null ids have no labels. Other columns
    of `docs` play no part, whatever their names.

    Only digests, ids and masks leave the tasks that read the texts. All copies of a text have
    the same bits but for the last, and of each text only the rows of the smallest id pass the
    last: they are counted as one row per text, partly combined in each task, and what is left of
    all rows fails. So no join meets a hot text.
    """
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())]
    slim = docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        # null ids find no label; dealt out by text, they never meet in one task
        F.when(F.col(doc_id).isNull(), F.xxhash64(F.col(text))).otherwise(0).alias("deal"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).alias("bits"),
        F.unhex(F.sha2(text_of(text), 256)).alias("digest"),
    )
    marked = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("deal"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    joined = slim.join(marked, ["id", "deal"], "left")
    flags = [F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c) for c in ("good", "toxic")]
    # rows that repeat in id and text as well are one row with a number
    rows = (
        joined.select("id", "digest", "part", "bits", *flags)
        .groupBy("id", "digest", "part", "bits", "good", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    same = ["part", "bits", "good", "toxic"]
    of_id = rows.groupBy("digest", "id").agg(F.collect_list(F.struct(*same, "n")).alias("rows"))
    last = F.struct(F.col("id").isNull().alias("missing"), F.col("id"))
    first = of_id.groupBy("digest").agg(F.min_by("rows", last).alias("rows"))
    passing = first.select(F.inline("rows")).groupBy(*same).agg(F.sum("n").alias("n"))
    everything = rows.groupBy(*same).agg(F.sum("n").alias("n"))
    copied = 1 << len(bits)
    signed = (
        everything.select(*same, "n", F.lit(copied).alias("add"))
        .unionByName(passing.select(*same, (-F.col("n")).alias("n"), F.lit(copied).alias("add")))
        .unionByName(passing.select(*same, "n", F.lit(0).alias("add")))
    )
    return (
        signed.groupBy("part", (F.col("bits") + F.col("add")).cast("int").alias("mask"))
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("good")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        )
        .filter(F.col("n") > 0)
    )


def audit(masks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per part, order of the filters and step: documents kept, removed, failing but removed
    earlier (`redundant`), failing this filter only (`unique_fails`), good and toxic ones removed,
    and `shapley`, what the filter removes summed over all orders.

    `masks` is as `failure_masks` gives it, bit i standing for names[i]; a part has at most one row
    per mask, so its diagram is small however many documents it counts. Parts without documents,
    and an empty table, have no rows.
    """
    names = list(names)
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters")
    columns = STEP_SCHEMA.replace(",", "").split()[::2]

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        masks = {
            int(m): (int(n), int(good), int(toxic))
            for m, n, good, toxic in rows[["mask", "n", "good", "toxic"]].itertuples(index=False)
        }
        part = rows["part"].iloc[0]
        return pd.DataFrame([(part, *r) for r in steps_of_orders(names, masks)], columns=columns)

    return masks.groupBy("part").applyInPandas(steps, STEP_SCHEMA)


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of five filters per language: A to D of `quality_filters`, and E, an exact copy."""
    conditions = quality_filters(text_of("text"))
    return audit(failure_masks(docs, labels, conditions), [*conditions, "E"])
