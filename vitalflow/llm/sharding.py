"""A uniform shuffle into shards of exact sizes, by a communication matrix.

How many rows of each partition go to each shard is drawn before any row moves: in a uniform
shuffle these counts have a hypergeometric law, given the sizes of partitions and shards. The
partitions are halved again and again; of what a group of them still owes every shard, the first
half's part is drawn, and the rest is the second half's. Then every partition is permuted by itself
and its rows are dealt out in runs of the counts drawn, the rows are exchanged, and every shard is
permuted again. All of it is DataFrame expressions; random numbers are hashes of a seed and a place,
so a task that is run again draws the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalflow.session import fresh_path, staged

SHARDS = 16
SEED = 13
#: Rows of a shard that are permuted in one task, about.
BLOCK_ROWS = 100_000
#: Blocks of a shard at least, so that a few shards keep many tasks busy.
BLOCKS = 16
#: Halvings of the list of partitions before its parts are spread over tasks.
HALVINGS_IN_ONE_TASK = 6
#: Values a count may take up to which its chances are added up one by one.
LISTED = 200
#: Tries of the rejection sampler, each accepted with a chance of over one half.
TRIES = 128
#: Below this, logarithms of factorials are sums of logarithms.
SMALL = 16


# ---- random numbers and factorials -------------------------------------------------------


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def uniform(*place: Column) -> Column:
    """A number between 0 and 1, neither of them, that depends on the place alone."""
    return (F.shiftrightunsigned(F.xxhash64(*place), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def _tail(n: Column) -> Column:
    """What Stirling's formula leaves of ln n!, for n from SMALL up."""
    square = n * n
    return (F.lit(1 / 12) - (F.lit(1 / 360) - F.lit(1 / 1260) / square) / square) / n


def _small_log_factorial(n: Column) -> Column:
    table = [math.lgamma(k + 1) for k in range(SMALL)]
    return F.element_at(F.array(*[F.lit(v) for v in table]), n.cast("int") + 1)


def _log_factorial(n: Column) -> Column:
    n = n.cast("double")
    large = (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + _tail(n)
    return F.when(n < SMALL, _small_log_factorial(n)).otherwise(large)


def _log_factorial_ratio(a: Column, b: Column) -> Column:
    """ln (a! / b!), exact also where both are large and near each other."""

    def ratio(x: Column) -> Column:
        a, b = x["a"], x["b"]
        near = (b + 0.5) * F.log1p((a - b) / b) + (a - b) * (F.log(a) - 1) + _tail(a) - _tail(b)
        return F.when(F.least(a, b) < SMALL, _log_factorial(a) - _log_factorial(b)).otherwise(near)

    return _let(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")), ratio)


# ---- one count ---------------------------------------------------------------------------


def hypergeometric(good: Column, bad: Column, sample: Column, *place: Column) -> Column:
    """How many of `sample` rows drawn without return from `good` + `bad` rows are good ones.

    By symmetry the lesser kind and the lesser of the drawn and the left rows are used. Few possible
    values: chances are added up until they pass a random number. Many: rejection under a hat of
    constant middle and falling sides, whose cost does not depend on the counts. Should all tries
    fail (a chance below 2^-128), the likeliest value is taken.
    """
    given = F.struct(
        good.cast("bigint").alias("good"), bad.cast("bigint").alias("bad"),
        sample.cast("bigint").alias("sample"),
    )

    def lesser(g: Column) -> Column:
        total = g["good"] + g["bad"]
        return F.struct(
            *[g[c].alias(c) for c in ("good", "bad", "sample")],
            total.alias("total"),
            F.least(g["good"], g["bad"]).alias("few"),
            F.greatest(g["good"], g["bad"]).alias("many"),
            F.least(g["sample"], total - g["sample"]).alias("drawn"),
        )

    def of_lesser(s: Column) -> Column:
        return (
            F.when(F.least(s["few"], s["drawn"]) == 0, F.lit(0).cast("bigint"))
            .when(F.least(s["few"], s["drawn"]) <= LISTED, _listed(s, *place))
            .otherwise(_rejected(s, *place))
        )

    def back(s: Column) -> Column:
        def undo(k: Column) -> Column:
            k = F.when(s["good"] > s["bad"], s["drawn"] - k).otherwise(k)
            return F.when(s["drawn"] < s["sample"], s["good"] - k).otherwise(k)

        return _let(of_lesser(s), undo)

    return _let(given, lambda g: _let(lesser(g), back))


def _listed(s: Column, *place: Column) -> Column:
    """The first k at which the chances of 0 to k pass a random number."""
    few, many, drawn = (s[c].cast("double") for c in ("few", "many", "drawn"))
    nothing = F.exp(
        _log_factorial_ratio(many, many - drawn)
        + _log_factorial_ratio(few + many - drawn, few + many)
    )
    start = F.struct(
        uniform(*place).alias("left"), nothing.alias("chance"), F.lit(-1).cast("bigint").alias("k")
    )

    def add(state: Column, at: Column) -> Column:
        k = at.cast("double")
        following = (few - k) * (drawn - k) / ((k + 1) * (many - drawn + k + 1))
        found = F.when((state["k"] < 0) & (state["left"] < state["chance"]), at).otherwise(state["k"])
        return F.struct(
            (state["left"] - state["chance"]).alias("left"),
            (state["chance"] * following).alias("chance"),
            found.cast("bigint").alias("k"),
        )

    most = F.least(s["few"], s["drawn"])
    # rounding may leave a random number next to 1 unpassed: it belongs to the last value
    return F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), most), start, add,
        lambda state: F.when(state["k"] < 0, most).otherwise(state["k"]),
    )


def _rejected(s: Column, *place: Column) -> Column:
    """Ratio of uniforms: a point under the hat is kept with the chance that its value has."""
    few, many, drawn, total = (s[c].cast("double") for c in ("few", "many", "drawn", "total"))
    share = few / total
    spread = F.sqrt((total - drawn) * drawn * share * (1 - share) / (total - 1) + 0.5)
    hat = F.struct(
        (drawn * share + 0.5).alias("middle"),
        # the width that covers every law of one peak with this spread
        (spread * (2 * math.sqrt(2 / math.e)) + (3 - 2 * math.sqrt(3 / math.e))).alias("width"),
        F.floor((drawn + 1) * (few + 1) / (total + 2)).cast("double").alias("peak"),
    )

    def draw(h: Column) -> Column:
        def value(u: Column, v: Column) -> Column:
            return F.floor(h["middle"] + h["width"] * (v - 0.5) / u).cast("double")

        def fits(u: Column, k: Column) -> Column:
            height = (
                _log_factorial_ratio(h["peak"], k)
                + _log_factorial_ratio(few - h["peak"], few - k)
                + _log_factorial_ratio(drawn - h["peak"], drawn - k)
                + _log_factorial_ratio(many - drawn + h["peak"], many - drawn + k)
            )
            inside = (k >= 0) & (k <= F.least(few, drawn))
            return F.when(inside, 2 * F.log(u) <= height).otherwise(F.lit(False))

        def attempt(t: Column) -> Column:
            u, v = uniform(t, F.lit("u"), *place), uniform(t, F.lit("v"), *place)
            point = F.struct(u.alias("u"), value(u, v).alias("k"))
            return _let(point, lambda p: F.when(fits(p["u"], p["k"]), p["k"].cast("bigint")))

        first = F.aggregate(
            F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("bigint"),
            lambda found, t: F.coalesce(found, attempt(t)),
        )
        return F.coalesce(first, h["peak"].cast("bigint"))

    return _let(hat, draw)


def multivariate_hypergeometric(owed: Column, sample: Column, *place: Column) -> Column:
    """How many of `sample` rows drawn without return are of each kind, of `owed` rows of each."""
    start = F.struct(
        sample.cast("bigint").alias("left"),
        F.aggregate(owed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.array().cast("array<bigint>").alias("drawn"),
    )

    def next_kind(state: Column, kind: Column) -> Column:
        at = F.size(state["drawn"])
        hit = hypergeometric(kind, state["total"] - kind, state["left"], at, *place)
        return _let(
            hit,
            lambda k: F.struct(
                (state["left"] - k).alias("left"),
                (state["total"] - kind).alias("total"),
                F.concat(state["drawn"], F.array(k)).alias("drawn"),
            ),
        )

    return F.aggregate(owed, start, next_kind, lambda state: state["drawn"])


# ---- the matrix --------------------------------------------------------------------------


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that add up to `rows` and are at most one apart, the larger ones first."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def communication_matrix(counts: DataFrame, sizes: list[int], seed: int = SEED) -> DataFrame:
    """(part, counts): rows that each partition sends to each shard, in a uniform shuffle.

    `counts` has (part, n), one row per partition, numbers that add up to that of `sizes`. What one
    task holds is one number per partition, until the list is halved often enough to be spread.
    """
    parts = counts.count()
    halvings = max(parts - 1, 0).bit_length()
    entry = F.struct(F.col("part").cast("bigint").alias("part"), F.col("n").cast("bigint").alias("n"))
    whole = counts.agg(F.array_sort(F.collect_list(entry)).alias("parts")).select(
        F.struct(
            "parts", F.array(*[F.lit(s).cast("bigint") for s in sizes]).alias("owed")
        ).alias("group")
    )
    at_once = min(halvings, HALVINGS_IN_ONE_TASK)
    groups = whole.select(F.explode(_halved(F.col("group"), at_once, seed)).alias("group"))
    if halvings > at_once:
        spread = groups.repartition(F.col("group.parts")[0]["part"])
        rest = _halved(F.col("group"), halvings - at_once, seed)
        groups = spread.select(F.explode(rest).alias("group"))
    one = groups.filter(F.size("group.parts") == 1)
    return one.select(
        F.col("group.parts")[0]["part"].alias("part"), F.col("group.owed").alias("counts")
    )


def _halved(group: Column, times: int, seed: int) -> Column:
    """The groups that `group`, a list of partitions and what they owe each shard, is halved into."""
    if times == 0:
        return F.array(group)

    def halve(g: Column) -> Column:
        parts, owed = g["parts"], g["owed"]
        half = F.ceil(F.size(parts) / 2).cast("int")
        first = F.slice(parts, F.lit(1), half)
        second = F.slice(parts, half + 1, F.size(parts) - half)
        rows = F.aggregate(first, F.lit(0).cast("bigint"), lambda a, p: a + p["n"])
        # no two groups have both the first partition and the number of them in common
        drawn = multivariate_hypergeometric(owed, rows, F.lit(seed), parts[0]["part"], F.size(parts))

        def two(share: Column) -> Column:
            left = F.zip_with(owed, share, lambda a, b: a - b)
            return F.array(
                F.struct(first.alias("parts"), share.alias("owed")),
                F.struct(second.alias("parts"), left.alias("owed")),
            )

        return F.when(F.size(parts) <= 1, F.array(g)).otherwise(_let(drawn, two))

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(times)),
        F.array(group),
        lambda groups, _: F.flatten(F.transform(groups, halve)),
    )


# ---- rows --------------------------------------------------------------------------------


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`docs` with `shard` (from 0) and `slot`, the row's place in its shard (from 0, no gaps).

    A uniform shuffle: all orders of the rows are equally likely, and the sizes of shards are at
    most one apart, whatever keys, texts or copies the rows hold. Nulls, repeated rows and empty
    texts are rows like others; an empty table gives no rows. Columns named `shard` or `slot` are
    replaced, other names do not matter. A repeated run on the same files with the same settings
    gives the same shards. Rows are written once, permuted by partition, below the shared folder,
    and cross the network once.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    numbered = docs.select(row, F.monotonically_increasing_id().alias("row_key"))
    order = [F.xxhash64(F.lit(seed), "row_key"), F.col("row_key")]
    permuted = numbered.sortWithinPartitions(*order).select(
        F.spark_partition_id().cast("bigint").alias("part"),
        # rows are numbered in the order that the sort gave them
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        "row",
    )
    rows = staged(permuted, "permuted")
    counts = staged(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "partition-rows")
    total = counts.agg(F.sum("n")).first()[0] or 0
    sizes = shard_sizes(total, shards)
    # read back, so that Spark knows the size of the matrix and broadcasts a small one only
    matrix = staged(communication_matrix(counts, sizes, seed), "matrix")
    upto = F.aggregate(
        "counts",
        F.array().cast("array<bigint>"),
        lambda done, n: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)),
    )
    bounds = matrix.select("part", upto.alias("_upto"))
    blocks = max(BLOCKS, -(-sizes[0] // BLOCK_ROWS))
    # the second permutation sorts each shard by a random number, in blocks of its leading digits
    again = F.xxhash64(F.lit(seed + 1), "part", "place")
    dealt = rows.join(bounds, "part").select(
        F.size(F.filter("_upto", lambda end: end <= F.col("place"))).alias("shard"),
        F.pmod(F.shiftright(again, 32), F.lit(blocks)).cast("int").alias("_block"),
        again.alias("_again"), "part", "place", "row",
    )
    in_block = dealt.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(
        in_block.select("shard", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from")),
        "blocks",
    )
    by_block = Window.partitionBy("shard", "_block").orderBy("_again", "part", "place")
    placed = dealt.withColumn("_at", F.row_number().over(by_block)).join(starts, ["shard", "_block"])
    return placed.select(
        "row.*", F.col("shard"), (F.col("_from") + F.col("_at") - 1).alias("slot")
    )


def write_shards(
    docs: DataFrame, folder: str | None = None, shards: int = SHARDS, seed: int = SEED
) -> str:
    """Write `docs` shuffled as Parquet, a folder `shard=j` for each shard, files in slot order.

    Returns the folder, a new one below the shared folder if none is given.
    """
    path = folder or fresh_path(docs.sparkSession, "shards")
    placed = shard_rows(docs, shards, seed)
    (
        placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
    return path


def document_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    The law is `rows`: counts of shards are at most one apart. One more shard deals all rows anew,
    so `grown_shard` is null. A null text has no bytes, and so size 1.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return shard_rows(slim, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
