"""Ranking, history, replay and splitting operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn
from vitalflow.operators.ordered import position, top_per_key
from vitalflow.session import staged


def _newest_first(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Newest first; rows that tie come in an order that only depends on their values."""
    return [*[F.col(c).desc() for c in order], F.xxhash64(*df.columns)]


def latest_per_id(df: DataFrame, order: Sequence[str] = ("time_ms",)) -> DataFrame:
    """Newest row of each person."""
    return top_per_key(df, ["id"], _newest_first(df, order), 1)


def rolling_history(
    df: DataFrame, order: Sequence[str] = ("time_ms",), size: int = S.HISTORY
) -> DataFrame:
    """Newest `size` rows of each person."""
    return top_per_key(df, ["id"], _newest_first(df, order), size)


def delta_vs_history_mean(
    df: DataFrame,
    columns: Sequence[str] = ("HR", "TEMP", "EDA", "Z"),
    order: Sequence[str] = ("time_ms",),
    size: int = S.HISTORY,
    present: str = "HR",
) -> DataFrame:
    """Latest reading of each person and its distance from the mean of the history.

    History rows without `present` are left out, after the history has been cut to size.
    """
    history = rolling_history(df, order, size).dropna(subset=[present])
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("newest")
    means = [F.avg(c).alias(f"mean_{c}") for c in columns]
    joined = history.groupBy("id").agg(newest, *means)
    return joined.select(
        "id",
        *[F.col(f"newest.{c}").alias(c) for c in columns],
        *[(F.col(f"newest.{c}") - F.col(f"mean_{c}")).alias(f"delta_{c}") for c in columns],
    )


def disagreement_log(
    history: DataFrame,
    order: Sequence[str] = ("time_ms",),
    models: tuple[str, str] = ("pred_lgbm", "pred_gb"),
    cap: int = 10,
    carry_over: bool = False,
) -> DataFrame:
    """Rows where the two models differ, by person and newest first, up to `cap`.

    With `carry_over` each person after the one that filled the log may still add a newest row
    that disagrees, because the cap is looked at only after a row was taken.
    """
    a, b = models
    newest = _newest_first(history, order)
    differing = history.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    log = differing.orderBy(F.col("id"), *newest).limit(cap)
    if not carry_over:
        return log
    filled_by = log.agg(F.when(F.count(F.lit(1)) >= cap, F.max("id")))
    late = latest_per_id(history, order).filter(F.col("id") > filled_by.scalar())
    return log.unionByName(late.filter(F.col(a) != F.col(b)))


def numbered(
    df: DataFrame, order: str = "seq", name: str = "pos"
) -> DataFrame:
    """Add each reading's 0-based position in its person's file order; rows without id are left out."""
    known = df.filter(F.col("id").isNotNull())
    return position(known, ["id"], [order], name)


def synthetic_clock(
    df: DataFrame,
    start_us: int,
    order: str = "seq",
    step_ms: int = S.EVENT_STEP_MS,
) -> DataFrame:
    """Replace the time by start + position * step, per person in file order."""
    placed = numbered(df, order, "pos")
    return with_clock(placed, start_us, step_ms).drop("pos")


def with_clock(placed: DataFrame, start_us: int, step_ms: int = S.EVENT_STEP_MS) -> DataFrame:
    us = F.lit(start_us).cast("bigint") + F.col("pos") * F.lit(step_ms * 1_000)
    return placed.withColumn("clock_us", us).withColumn(
        "datetime", fn.format_event_time(F.timestamp_micros("clock_us"))
    )


def replay_batches(
    df: DataFrame,
    start_us: int,
    order: str = "seq",
    per_person: int = S.EVENTS_PER_SEND,
    step_ms: int = S.EVENT_STEP_MS,
) -> DataFrame:
    """Sends of `per_person` readings a person; the send in which the first file ends is the last."""
    batch = F.floor(F.col("pos") / F.lit(per_person)).cast("bigint")
    placed = numbered(df, order, "pos").withColumn("batch", batch)
    sizes = df.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    last = sizes.agg(F.floor(F.min("n") / F.lit(per_person)).cast("bigint"))
    return with_clock(placed.filter(F.col("batch") <= last.scalar()), start_us, step_ms)


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "seq",
    test_share: float = 0.2,
    seed: int = 42,
    digit_bits: tuple[int, ...] = (10, 11, 11),
) -> DataFrame:
    """Add `is_test`: an exact, repeatable share of each class, by hash order of `key`.

    The test set has ceil(share * rows) rows. Each class gets its proportional part, and rows
    left over by rounding go to the training parts with the largest remainders. Rows whose label
    is null or none of the classes belong to neither part: their `is_test` is null.

    No row is shuffled: label, key and hash are written once; the hash at which a class's test part
    ends is found by counting its leading bits, then the next ones among rows that share the digits
    found, until all bits are; only rows with equal hashes are ranked. One cut per class is what
    the rows are compared with.
    """
    known = F.coalesce(F.col(label).isin(*S.CLASSES), F.lit(False))
    narrow = df.filter(known).select(label, key).withColumn("_hash", fn.stable_hash(key, seed))
    hashed = staged(narrow, "split-hashes")
    shift = 32 - digit_bits[0]
    sizes = _sizes(hashed, label, [], shift)
    counts = sizes.groupBy(label).agg(F.sum("_n").alias("n"))
    quotas = _test_quota(counts, label, test_share).withColumnRenamed("_n_test", "_rank")
    place = _place(sizes.join(F.broadcast(quotas), label), label)
    for bits in digit_bits[1:]:
        near = _at_digits(hashed, place, label, shift)
        shift -= bits
        place = _place(_sizes(near, label, ["_rank"], shift), label)
    near = _at_digits(hashed, place, label, shift)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_hash", key))
    cut = (
        near.select(label, "_hash", key, "_rank", rank.alias("_place"))
        .filter(F.col("_place") == F.col("_rank"))
        .select(label, F.col("_hash").alias("_cut_hash"), F.col(key).alias("_cut_key"))
    )
    is_test = F.struct("_hash", key) <= F.struct("_cut_hash", "_cut_key")
    rows = df.withColumn("_hash", fn.stable_hash(key, seed)).join(F.broadcast(cut), label, "left")
    told = F.coalesce(F.col("_cut_hash").isNotNull() & is_test, F.lit(False))
    return rows.select(*df.columns, F.when(known, told).alias("is_test"))


def _sizes(rows: DataFrame, label: str, kept: list[str], shift: int) -> DataFrame:
    """Rows of each class per value of the hash's leading bits."""
    digits = F.floor(F.col("_hash") / F.lit(1 << shift)).cast("bigint")
    return rows.groupBy(label, *kept, digits.alias("_digits")).agg(F.count(F.lit(1)).alias("_n"))


def _place(sizes: DataFrame, label: str) -> DataFrame:
    """Leading bits among which each class's row number `_rank` is, and its number there."""
    up_to = F.sum("_n").over(Window.partitionBy(label).orderBy("_digits"))
    ranged = sizes.withColumn("_before", up_to - F.col("_n"))
    here = F.col("_rank").between(F.col("_before") + 1, F.col("_before") + F.col("_n"))
    return ranged.filter(here).select(
        label, (F.col("_rank") - F.col("_before")).alias("_rank"), "_digits"
    )


def _at_digits(hashed: DataFrame, place: DataFrame, label: str, shift: int) -> DataFrame:
    """Rows whose leading hash bits are those of their class's `place` (one row per class)."""
    same = F.floor(F.col("_hash") / F.lit(1 << shift)).cast("bigint") == F.col("_digits")
    return hashed.join(F.broadcast(place), label).filter(same).drop("_digits")


def _test_quota(counts: DataFrame, label: str, share: float) -> DataFrame:
    """Test rows per class, from at most one row for each of `CLASSES`."""
    collected = counts.agg(
        F.collect_list(F.struct(label, "n")).alias("classes"), F.sum("n").alias("total")
    )
    train = F.col("total") - F.ceil(F.col("total") * F.lit(share)).cast("bigint")
    exact = F.col("c.n") * F.col("train") / F.col("total")
    parts = collected.select(F.explode("classes").alias("c"), "total", train.alias("train")).select(
        F.col(f"c.{label}").alias(label),
        F.col("c.n").alias("n"),
        "train",
        F.floor(exact).cast("bigint").alias("whole"),
        (exact - F.floor(exact)).alias("rest"),
    )
    everyone = Window.partitionBy("train")
    by_rest = everyone.orderBy(F.col("rest").desc(), F.col(label))
    spare = F.col("train") - F.sum("whole").over(everyone)
    extra = F.when(F.row_number().over(by_rest) <= spare, 1).otherwise(0)
    return parts.select(label, (F.col("n") - F.col("whole") - extra).alias("_n_test"))
