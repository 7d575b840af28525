"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected the same number of times: the source's target over its
size. The expected copies are summed along the source, one offset is added, and a document is
emitted once for every whole number its stretch of the sum crosses. So counts differ from the
expected ones by less than one anywhere along the order, and with the documents in order of size
the words taken stay within about one document of the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import WORD, numbered_rows, text_of
from vitalflow.operators.ordered import position
from vitalflow.session import staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    size: str = "source_size",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Words to take of each source: `share` of all words, dealt out by weight.

    Sources in code point order (null last) have the weights in turn. A target stops at `most`
    times its source's size; what is over goes to the others by weight, until none is above. Each
    round is one aggregate over the sources, which gives two numbers; a round stops more sources
    or is the last. An empty table has no targets.
    """
    ranked = position(sizes, [], [F.col(source).asc_nulls_last()], "_rank")
    turn = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")
    )
    parts = staged(
        ranked.select(source, size, turn.cast("bigint").alias("weight")), "mix-sources"
    )
    limit = F.col(size) * F.lit(float(most))
    total = parts.agg(F.sum(size)).first()[0] or 0
    rate, stopped = 0.0, -1
    while True:
        # a source stops when its limit is below its part at the current rate
        full = limit < F.col("weight") * F.lit(rate) if stopped >= 0 else F.lit(False)
        taken, weight, count = parts.agg(
            F.sum(F.when(full, F.col(size)).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.count_if(full),
        ).first()
        if not weight:
            rate = float("inf")
            break
        if count == stopped:
            break
        stopped = count
        rate = (float(total) * share - float(taken) * most) / float(weight)
    wanted = F.least(limit, F.col("weight") * F.lit(rate))
    return parts.select(source, size, "weight", wanted.alias("target"))


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document its size, its source's size and target, and `copies`: how often it is taken.

    Documents of a source are laid in order of size, largest first, then id; the offset is a hash
    of seed and source, so reruns agree. Null texts have size 0, null sources form one source. A
    source without words has target 0 and its documents are not taken. Rows that are equal in
    source, size and id share their copies in any order. An empty table gives no rows. Columns
    named in `keep` come along; others are not read.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text_of(text)).alias("size"),
        *keep,
    )
    rows = staged(sized, "mix-sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights=weights, share=share, most=most)
    order = [F.col("size").desc(), F.col("doc_id").asc_nulls_last()]
    placed = position(rows, ["source"], order, "_place")
    named = targets.withColumnRenamed("source", "_source")
    joined = placed.join(named, F.col("source").eqNullSafe(F.col("_source")), "left")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    return joined.select(*columns, copies(seed), *keep)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: every row as often as it is taken, all columns as they were."""
    rows, _ = numbered_rows(docs, "mix-rows")
    names = {k: options.pop(k, k) for k in ("doc_id", "source", "text")}
    flat = rows.select("row_key", *[F.col("row").getField(c).alias(k) for k, c in names.items()])
    plan = mix_plan(flat, keep=["row_key"], **options).filter("copies > 0")
    repeated = rows.join(plan.select("row_key", "copies"), "row_key")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return repeated.select("row", times.alias("_copy")).select("row.*")


def copies(seed: str) -> Column:
    """Whole numbers crossed by the document's stretch of the running sum of expected copies."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))
    offset = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    up_to = F.floor((F.col("_place") + 1) * rate + offset)
    before = F.floor(F.col("_place") * rate + offset)
    return (up_to - before).cast("bigint").alias("copies")
