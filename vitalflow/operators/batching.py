"""Micro-batches that close at a number of records or after a time, on recorded logs.

A live query gets such batches from its trigger (`sources.streams.count_or_time_trigger`). On a
recorded log each batch depends on where the one before it ended, over the whole partition. To
keep that off a single task, positions are cut into blocks. Where a batch starts inside a block
follows from where the first one starts, and there are only `size` possible places for that; so
every block says, for each of those places, where the next block's first batch starts. These
short maps are put together per group of blocks, then per partition, and handed back down.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.operators.ordered import position
from vitalflow.session import staged

BLOCK_RECORDS = 100_000
BLOCKS_PER_GROUP = 512


def count_or_time_batches(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    time_ms: str,
    size: int = S.BATCH_RECORDS,
    wait_ms: int = S.BATCH_SECONDS * 1_000,
    block_records: int = BLOCK_RECORDS,
    blocks_per_group: int = BLOCKS_PER_GROUP,
) -> DataFrame:
    """Add `batch_start`, the position in its partition of the batch's first record.

    A batch closes with its `size`-th record, or before the first record that arrives more than
    `wait_ms` after the batch's first. `keys` name the log partition (may be empty); `order`
    sorts its records, and their times must not decrease along it.
    """
    if block_records < size:
        raise ValueError("a block must hold at least one whole batch")
    part = [*keys, "_block"]
    columns = [*df.columns, "batch_start"]
    # both tables are read more than once below: the rows in order, and the blocks' maps
    placed = staged(position(df, list(keys), list(order), "_pos"), "placed")
    block = F.floor(F.col("_pos") / block_records).cast("bigint")
    head = (F.col("_pos") % block_records < size) & (block > 0)
    # the first records of a block are also shown to the block before it
    seen_by = F.when(head, F.array(block, block - 1)).otherwise(F.array(block))
    shown = placed.withColumn("_block", F.explode(seen_by))

    key_fields = [df.schema[k] for k in keys]
    exits = T.StructField("_exits", T.ArrayType(T.IntegerType()))
    block_field, group_field, entry_field = (
        T.StructField(n, T.LongType()) for n in ("_block", "_group", "_entry")
    )

    def block_map(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_pos")
        number = int(frame["_block"].iloc[0])
        own = int((frame["_pos"] < (number + 1) * block_records).sum())
        found = _exits(_next_starts(frame[time_ms].to_numpy(), size, wait_ms), own, size)
        return frame.head(1)[part].assign(_exits=[found.tolist()])

    mapped = (
        shown.select(*part, "_pos", time_ms)
        .groupBy(*part)
        .applyInPandas(block_map, T.StructType([*key_fields, block_field, exits]))
        .withColumn("_group", F.floor(F.col("_block") / blocks_per_group).cast("bigint"))
    )
    maps = staged(mapped, "block-maps")

    def group_map(frame: pd.DataFrame) -> pd.DataFrame:
        at = np.arange(size)
        for step in frame.sort_values("_block")["_exits"]:
            at = np.where(at >= 0, np.asarray(step)[at], -1)
        return frame.head(1)[[*keys, "_group"]].assign(_exits=[at.tolist()])

    def group_entries(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_group")
        return frame[[*keys, "_group"]].assign(_entry=_walk(0, frame["_exits"]))

    def block_entries(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_block")
        entry = int(frame["_entry"].iloc[0])
        return frame[part].assign(_entry=_walk(entry, frame["_exits"]))

    grouped = maps.groupBy(*keys, "_group").applyInPandas(
        group_map, T.StructType([*key_fields, group_field, exits])
    )
    of_groups = grouped.groupBy(*keys).applyInPandas(
        group_entries, T.StructType([*key_fields, group_field, entry_field])
    )
    of_blocks = (
        maps.join(of_groups, [*keys, "_group"])
        .groupBy(*keys, "_group")
        .applyInPandas(block_entries, T.StructType([*key_fields, block_field, entry_field]))
    )

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_pos")
        number, entry = int(frame["_block"].iloc[0]), int(frame["_entry"].iloc[0])
        if entry < 0:
            return frame.head(0).assign(batch_start=0)[columns]
        own = int((frame["_pos"] < (number + 1) * block_records).sum())
        following = _next_starts(frame[time_ms].to_numpy(), size, wait_ms)
        starts, at = [], entry
        while at < own:
            starts.append(at)
            at = int(following[at])
        mine = frame.iloc[entry:at]
        which = np.searchsorted(starts, np.arange(entry, entry + len(mine)), side="right") - 1
        begin = mine["_pos"].to_numpy()[np.asarray(starts, dtype=int)[which] - entry]
        return mine.assign(batch_start=begin)[columns]

    start_field = T.StructField("batch_start", T.LongType())
    return (
        shown.join(of_blocks, part)
        .groupBy(*part)
        .applyInPandas(assign, T.StructType([*df.schema.fields, start_field]))
    )


def _next_starts(times: np.ndarray, size: int, wait_ms: int) -> np.ndarray:
    """For a batch starting at each record, the place of the next batch's first record."""
    by_time = np.searchsorted(times, times + wait_ms, side="right")
    return np.minimum(by_time, np.arange(len(times)) + size)


def _exits(following: np.ndarray, own: int, size: int) -> np.ndarray:
    """Where the next block's first batch starts, for each place of this block's; -1 if nowhere."""
    at = following.copy()
    while (inside := at < own).any():
        at[inside] = at[at[inside]]
    out = np.full(size, -1)
    n = min(size, own)
    out[:n] = np.where(at[:n] < len(following), at[:n] - own, -1)
    return out


def _walk(entry: int, steps: Sequence[Sequence[int]]) -> list[int]:
    """Entry of each step when the first is entered at `entry`."""
    out = []
    for step in steps:
        out.append(entry)
        entry = int(step[entry]) if entry >= 0 else -1
    return out
