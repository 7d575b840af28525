"""Ordered computations that stay spread out when one key holds most of the rows.

A plain window over a hot key puts all its rows into one task. Here the rows are range-partitioned
by (keys, order): Spark samples the bounds, so partitions hold equal numbers of rows whatever the
distances between order values are, and one key may fill many of them. Each task works on the
stretches of equal keys in its partition. What crosses a boundary is one row per partition, which
carries the end of its last key forward. Rows are shuffled once and written once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from vitalflow.session import staged

#: What stands for "no value yet" while maxima and minima of whole numbers are folded.
_NONE = {"max": np.iinfo(np.int64).min, "min": np.iinfo(np.int64).max}
_FOLD = {"sum": F.sum, "max": F.max, "min": F.min}

Compute = Callable[[Mapping[str, pa.ChunkedArray], np.ndarray], Mapping[str, object]]


def in_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    compute: Compute,
    fields: Sequence[T.StructField],
    name: str = "ordered",
) -> DataFrame:
    """`df` in range partitions of (keys, order), with the columns that `compute` adds.

    `compute(columns, starts)` gets the rows of one partition in order and the row numbers at
    which a new key starts; it returns the values of `fields`. A task holds its partition in
    memory, so size partitions with `spark.sql.shuffle.partitions`. Also added: `_part`, the
    number of the partition; `_head`, whether the row's key is the first of the partition;
    `_end`, whether it is the partition's last row. The result is written to the shared folder.
    """
    keys = list(keys)
    extra = [
        *fields,
        T.StructField("_part", T.IntegerType()),
        T.StructField("_head", T.BooleanType()),
        T.StructField("_end", T.BooleanType()),
    ]
    schema = T.StructType([*df.schema.fields, *extra])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        starts = _run_starts(table, keys)
        added = compute({c: table.column(c) for c in table.column_names}, starts)
        rows = np.arange(table.num_rows)
        head = rows < (starts[1] if len(starts) > 1 else table.num_rows)
        for field in fields:
            table = table.append_column(field.name, pa.array(added[field.name], from_pandas=True))
        number = TaskContext.get().partitionId()
        table = table.append_column("_part", pa.array(np.full(len(rows), number, dtype=np.int32)))
        table = table.append_column("_head", pa.array(head))
        table = table.append_column("_end", pa.array(rows == len(rows) - 1))
        yield from table.to_batches(max_chunksize=10_000)

    columns = [*keys, *order]
    sorted_rows = (
        df.repartitionByRange(*columns).sortWithinPartitions(*columns) if columns else df.coalesce(1)
    )
    return staged(sorted_rows.mapInArrow(work, schema), name)


def _run_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Row numbers at which a key begins; equal keys lie together, nulls equal each other."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        codes = table.column(key).combine_chunks().dictionary_encode()
        at = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed[1:] |= at[1:] != at[:-1]
    return np.flatnonzero(changed)


def key_so_far(keys: Sequence[str]) -> WindowSpec:
    """The window over a key's partitions up to this one, for their last rows."""
    by_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part")
    return by_key.rowsBetween(Window.unboundedPreceding, 0)


def hand_on(summed: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """What each partition of `in_runs` gets from those before it.

    `summed` has one row per partition, its last row, with `names` summed up over the key so far.
    """
    following = F.lead("_part").over(Window.orderBy("_part")).alias("_part")
    return summed.select(
        following, *[F.col(k).alias(f"_of_{k}") for k in keys], *names
    ).filter(F.col("_part").isNotNull())


def with_carry(rows: DataFrame, keys: Sequence[str], carried: DataFrame) -> DataFrame:
    """Rows with the carried columns, null where nothing precedes; the carried side has one row
    per partition."""
    same = (rows["_part"] == carried["_part"]) & rows["_head"]
    for k in keys:
        same = same & rows[k].eqNullSafe(carried[f"_of_{k}"])
    return rows.join(F.broadcast(carried), same, "left").drop(carried["_part"])


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    **folds: tuple[str, Column],
) -> DataFrame:
    """Add, per name in `folds`, the fold (sum, max, min) over all earlier rows of the key.

    Folded values are whole numbers; nulls are passed over. Nothing earlier gives 0 for sum,
    else null. A null key is a key of its own. Rows that tie in `order` come in any order.
    """
    rows = df.withColumns({f"_in_{n}": v.cast("bigint") for n, (_, v) in folds.items()})
    kinds = {n: kind for n, (kind, _) in folds.items()}
    fields = [T.StructField(f"{p}{n}", T.LongType()) for n in folds for p in ("_here_", "_upto_")]

    def compute(columns: Mapping[str, pa.ChunkedArray], starts: np.ndarray) -> dict[str, object]:
        out = {}
        for name, kind in kinds.items():
            before, up_to = fold_runs(columns[f"_in_{name}"], starts, kind)
            out[f"_here_{name}"], out[f"_upto_{name}"] = before, up_to
        return out

    placed = in_runs(rows, keys, order, compute, fields)
    so_far = key_so_far(keys)
    ends = placed.filter("_end").withColumns(
        {f"_carry_{n}": _FOLD[k](f"_upto_{n}").over(so_far) for n, k in kinds.items()}
    )
    joined = with_carry(placed, keys, hand_on(ends, keys, [f"_carry_{n}" for n in kinds]))
    return joined.select(*df.columns, *[_merged(n, k) for n, k in kinds.items()])


def fold_runs(column: pa.ChunkedArray, starts: np.ndarray, kind: str) -> tuple[pa.Array, pa.Array]:
    """Folds over the earlier rows of each run, and over those and the row itself."""
    none = _NONE.get(kind, 0)
    values = column.combine_chunks().fill_null(none).to_numpy(zero_copy_only=False)
    if kind == "sum":
        total = np.cumsum(values)
        base = np.repeat(total[starts] - values[starts], np.diff([*starts, len(values)]))
        up_to = total - base
        return pa.array(up_to - values), pa.array(up_to)
    run = np.repeat(np.arange(len(starts)), np.diff([*starts, len(values)]))
    grouped = pd.Series(values).groupby(run)
    up_to = (grouped.cummax() if kind == "max" else grouped.cummin()).to_numpy()
    before = np.empty_like(up_to)
    before[1:] = up_to[:-1]
    before[starts] = none
    return pa.array(before, mask=before == none), pa.array(up_to, mask=up_to == none)


def _merged(name: str, kind: str) -> Column:
    carried, here = F.col(f"_carry_{name}"), F.col(f"_here_{name}")
    if kind == "sum":
        return (F.coalesce(carried, F.lit(0)) + here).alias(name)
    return (F.greatest if kind == "max" else F.least)(carried, here).alias(name)


def position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str
) -> DataFrame:
    """Add the row's 0-based position within its key."""
    return running_before(df, keys, order, **{name: ("sum", F.lit(1))})


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, salts: int = 64
) -> DataFrame:
    """First `k` rows of each key by `order`.

    Every task keeps `k` rows a key before the shuffle. For k > 1 the rows of a key meet in two
    steps, per salt and then whole, so that many tasks times `k` rows never fall on one.
    """
    near = df
    if k > 1:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        ranked = salted.withColumn("_rank", F.row_number().over(part))
        near = ranked.filter(F.col("_rank") <= k).drop("_salt", "_rank")
    full = Window.partitionBy(*keys).orderBy(*order)
    return near.withColumn("_rank", F.row_number().over(full)).filter(F.col("_rank") <= k).drop("_rank")
