"""Keyed state on live streams: collected batches, the monitor's mode, the last readings.

State lies in Spark's state store, below the query's checkpoint folder, and is taken up again after a
restart. Each key's rows of a micro-batch come together in one task, which sorts them by `order`;
across micro-batches they must arrive in order. Keys should be many (log partitions, pipelines,
persons), as one key is one task's work, bounded by what a micro-batch reads. Batches and the
monitor's stretches get their rows packed, some thousand of a key in one, and work on arrays.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalflow import schemas as S
from vitalflow.operators.control import check_flags

BY_COUNT, BY_TIME = "count", "time"


def _sorted(rows: Iterator[Row], order: Sequence[str]) -> list[Row]:
    """By `order`, nulls first."""
    return sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in order))


def _with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in fields]])


# ---- packed rows -------------------------------------------------------------------------

#: Rows of a pack that is handed on.
PACK_ROWS = 50_000


def _as_pack(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return sink.getvalue().to_pybytes()


def _from_packs(packs: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(pack).read_all() for pack in packs)


def _packed(rows: DataFrame, keys: Sequence[str], event_time: str | None = None) -> DataFrame:
    """(keys, `_pack`): the rows of a stream, those of a key and an Arrow batch in one, with the latest
    `event_time` among them."""
    added = [] if event_time is None else [rows.schema[event_time]]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.zeros(batch.num_rows, dtype=np.int64)
            for k in keys:
                own = batch.column(k).dictionary_encode(null_encoding="encode")
                mixed = codes * len(own.dictionary) + own.indices.to_numpy(zero_copy_only=False)
                codes = np.unique(mixed, return_inverse=True)[1]
            places = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[places], prepend=-1))
            parts = [batch.take(pa.array(own)) for own in np.split(places, starts[1:])]
            columns = [batch.column(k).take(pa.array(places[starts])) for k in keys]
            columns.append(pa.array([_as_pack(part) for part in parts], pa.binary()))
            if event_time is not None:
                latest = [pc.max(part.column(event_time)) for part in parts]
                columns.append(pa.array([x.as_py() for x in latest], batch.column(event_time).type))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [*keys, "_pack", *[f.name for f in added]]
    fields = [*[rows.schema[k] for k in keys], T.StructField("_pack", T.BinaryType()), *added]
    return rows.mapInArrow(pack, T.StructType(fields))


def _unpacked(packs: DataFrame, schema: T.StructType) -> DataFrame:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("_pack"):
                yield from pa.ipc.open_stream(pack.as_buffer())

    return packs.mapInArrow(unpack, schema)


def _in_order(rows: pa.Table, order: Sequence[str]) -> pa.Table:
    """By `order`, nulls first; rows that are equal in it stay as they came."""
    keys = [rows.column(c) for c in order]
    keys = [k.cast(pa.int8()) if pa.types.is_boolean(k.type) else k for k in keys]
    table = pa.table(keys, [str(i) for i in range(len(keys))])
    ascending = [(c, "ascending") for c in table.column_names]
    return rows.take(pc.sort_indices(table, sort_keys=ascending, null_placement="at_start"))


def _in_packs(rows: pa.Table) -> Iterator[bytes]:
    for at in range(0, rows.num_rows, PACK_ROWS):
        yield _as_pack(rows.slice(at, PACK_ROWS).combine_chunks())


# ---- batches by count or time ------------------------------------------------------------


class _Collector(StatefulProcessor):
    """The open batch of one key: its records, its number, when it began and how many it has."""

    def __init__(self, order: Sequence[str], time_ms: str | None, size: int, wait_ms: int):
        self.order, self.time_ms = list(order), time_ms
        self.size, self.wait_ms = size, wait_ms
        self.row = Row("_pack")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", "pack binary")
        self.head = handle.getValueState("head", "number long, first_ms long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = _in_order(_from_packs(row["_pack"] for row in rows), self.order)
        if self.time_ms:
            times = fresh.column(self.time_ms).to_numpy()
        else:
            times = np.full(fresh.num_rows, timerValues.getCurrentProcessingTimeInMs())
        number, first, n = self.head.get() or (0, None, 0)
        began, kept, at = first, n, 0
        ends: list[tuple[int, int, str]] = []  # of closed batches: number, place after the last fresh record, why
        while at < len(times):
            if not n:
                first = int(times[at])
            near = times[at : at + self.size - n]
            over = np.flatnonzero(near > first + self.wait_ms)
            more = int(over[0]) if len(over) else len(near)
            at, n = at + more, n + more
            if len(over) or n == self.size:
                ends.append((number, at, BY_TIME if len(over) else BY_COUNT))
                number, n = number + 1, 0
        if ends:
            numbers, upto, whys = zip(*ends)
            of = np.repeat(np.arange(len(ends)), np.diff(upto, prepend=-kept))
            closed = fresh.slice(0, upto[-1])
            if kept:
                closed = pa.concat_tables([self._taken(began), closed])
            yield from self._closed(closed, pa.array(numbers, pa.int64()).take(of), pa.array(whys).take(of))
            fresh = fresh.slice(upto[-1])
        if fresh.num_rows:
            self.records.appendValue((_as_pack(fresh.combine_chunks()),))
        if n:
            self.handle.registerTimer(first + self.wait_ms + 1)
        self.head.update((number, first if n else None, n))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        number, first, n = self.head.get() or (0, None, 0)
        if n and first + self.wait_ms < expiredTimerInfo.getExpiryTimeInMs():
            closed = self._taken(first)
            yield from self._closed(closed, pa.array([number] * n, pa.int64()), pa.array([BY_TIME] * n))
            self.head.update((number + 1, None, 0))

    def _taken(self, first: int) -> pa.Table:
        """The kept records of a batch that closes, which leaves nothing behind."""
        kept = _from_packs([pack for (pack,) in self.records.get()])
        self.records.clear()
        self.handle.deleteTimer(first + self.wait_ms + 1)
        return kept

    def _closed(self, records: pa.Table, numbers: pa.Array, whys: pa.Array) -> Iterator[Row]:
        told = records.append_column("batch", numbers).append_column("closed_by", whys)
        yield from map(self.row, _in_packs(told))


def collect_batches(
    records: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    time_ms: str | None = None,
    event_time: str | None = None,
    size: int = S.BATCH_RECORDS,
    wait_ms: int = S.BATCH_SECONDS * 1_000,
    delay: str = "1 second",
) -> DataFrame:
    """The records of a stream with `batch`, a number per key, and `closed_by`, when it closes.

    A batch closes with its `size`-th record (`count`), or when more than `wait_ms` have passed
    since its first one (`time`): a record that arrives later starts the next batch, and a timer
    closes the batch if none does. The open batch is kept in the state store, so at most `size`
    records a key, and its records come out once, when it closes; batches are whole in the
    micro-batch that closes them. `keys` name the log partition.

    Without `time_ms`, records arrive when their micro-batch starts and timers go by the clock: the
    live form. With it, the column holds arrival times that do not go down along the log, and
    `event_time` the same as a timestamp: timers then go by its watermark, so that a recorded log
    gives the same batches however it is cut into micro-batches. Arrival times must not be null.
    Records that come after the watermark count for nothing, unless they are read together with
    later ones of their key.
    """
    if (time_ms is None) != (event_time is None):
        raise ValueError("give both time_ms and event_time, or neither")
    mode = "ProcessingTime" if time_ms is None else "EventTime"
    packs = _packed(records, keys, event_time)
    source = packs if event_time is None else packs.withWatermark(event_time, delay)
    out = _with_fields(records.schema, ("batch", T.LongType()), ("closed_by", T.StringType()))
    collected = source.groupBy(*keys).transformWithState(
        statefulProcessor=_Collector(order, time_ms, size, wait_ms),
        outputStructType="_pack binary",
        outputMode="Append",
        timeMode=mode,
    )
    return _unpacked(collected, out)


# ---- the monitor's mode ------------------------------------------------------------------


class _Monitor(StatefulProcessor):
    """Whether a pipeline is in fallback, and how many breaches were counted since the last reset."""

    def __init__(self, names: Sequence[str], key: str, order: str, violations: int):
        self.order, self.violations = order, violations
        self.row = Row(*names, "was_fallback", "in_fallback", "violation_count")
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mode = handle.getValueState("mode", "in_fallback boolean, violation_count long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.mode.update((initialState["in_fallback"], initialState["violation_count"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        active, count = self.mode.get() or (False, 0)
        for row in _sorted(rows, [self.order]):
            before = active
            if active:
                active = not row["_stop"]
            else:
                count = count + 1 if row["breach"] else 0 if row["reset"] else count
                if count >= self.violations:
                    active, count = True, 0
            yield self.row(*[row[c] for c in self.names], before, active, count)
        self.mode.update((active, count))


def fallback_state_stream(
    checks: DataFrame,
    initial: DataFrame | None = None,
    key: str = "pipeline",
    order: str = "seq",
    limit_s: float = S.LAG_LIMIT_S,
    violations: int = S.VIOLATIONS,
    resume_share: float = S.RESUME_SHARE,
) -> DataFrame:
    """`operators.control.fallback_state` on a live stream of checks.

    The mode of each pipeline is one value in the state store. `initial`, a table of (key,
    in_fallback, violation_count) with one row per pipeline, is where a new query starts; a query
    that is started again goes on from its own state. `mode_state` reads the state back.
    """
    flagged = check_flags(checks, limit_s, resume_share)
    fields = ("was_fallback", T.BooleanType()), ("in_fallback", T.BooleanType()), ("violation_count", T.LongType())
    return flagged.groupBy(key).transformWithState(
        statefulProcessor=_Monitor(checks.columns, key, order, violations),
        outputStructType=_with_fields(checks.schema, *fields),
        outputMode="Append",
        timeMode="None",
        initialState=None if initial is None else initial.groupBy(key),
    )


class _Intervals(StatefulProcessor):
    """The monitor, with the time of the last check: each check ends the stretch that the one before
    it began."""

    def __init__(self, key: str, order: str, time_us: str, violations: int, kinds: pa.Schema):
        self.key, self.order, self.time_us, self.violations = key, order, time_us, violations
        self.kinds = kinds
        self.row = Row("_pack")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mode = handle.getValueState("mode", "in_fallback boolean, violation_count long")
        self.last = handle.getValueState("last", "at long, in_fallback boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        checks = _in_order(_from_packs(row["_pack"] for row in rows), [self.order])
        flags = (checks.column(c).to_numpy() for c in ("breach", "reset", "_stop"))
        modes, count = _modes(*flags, *(self.mode.get() or (False, 0)), self.violations)
        times = checks.column(self.time_us).combine_chunks()
        last, ended = self.last.get(), pa.array(modes)
        self.mode.update((bool(modes[-1]), count))
        self.last.update((times[-1].as_py(), bool(modes[-1])))
        start = [] if last is None else [last]
        began = pa.concat_arrays([pa.array([at for at, _ in start], pa.int64()), times[:-1]])
        within = pa.concat_arrays([pa.array([mode for _, mode in start], pa.bool_()), ended[:-1]])
        until = times[len(times) - len(began) :]
        keys = pa.array([key[0]] * len(began), self.kinds.field(0).type)
        yield from map(self.row, _in_packs(pa.Table.from_arrays([keys, began, until, within], schema=self.kinds)))


def _modes(
    breach: np.ndarray, reset: np.ndarray, stop: np.ndarray, active: bool, count: int, violations: int
) -> tuple[np.ndarray, int]:
    """The mode after each check, in order, and the breaches counted after the last one, where the
    monitor begins in a mode with so many breaches counted. What stops the fallback is a reset too,
    so breaches during the fallback, which do not count, are gone when it ends."""
    places = np.arange(len(breach))
    breaches = np.cumsum(breach) + count
    newest = np.maximum.accumulate(np.where(reset, places, -1))
    run = breaches - np.where(newest < 0, 0, breaches[newest])
    started = np.maximum.accumulate(np.where(run >= violations, places, -1))
    stopped = np.maximum.accumulate(np.where(stop, places, -1))
    modes = (started > stopped) | (active & (stopped < 0))
    return modes, 0 if modes[-1] else int(run[-1])


def mode_intervals_stream(
    checks: DataFrame,
    key: str = "pipeline",
    order: str = "seq",
    time_us: str = "check_us",
    limit_s: float = S.LAG_LIMIT_S,
    violations: int = S.VIOLATIONS,
    resume_share: float = S.RESUME_SHARE,
) -> DataFrame:
    """(key, from_us, until_us, in_fallback): the mode between a check and the next one of its
    pipeline, when that arrives."""
    flagged = check_flags(checks, limit_s, resume_share)
    out = T.StructType(
        [
            checks.schema[key], T.StructField("from_us", T.LongType()),
            T.StructField("until_us", T.LongType()), T.StructField("in_fallback", T.BooleanType()),
        ]
    )
    needed = flagged.select(key, order, F.col(time_us).cast("long"), "breach", "reset", "_stop")
    stretches = _packed(needed, [key]).groupBy(key).transformWithState(
        statefulProcessor=_Intervals(key, order, time_us, violations, to_arrow_schema(out)),
        outputStructType="_pack binary",
        outputMode="Append",
        timeMode="None",
    )
    return _unpacked(stretches, out)


#: Points and stretches meet in buckets of time, stretches in the first that are no shorter than they.
JOIN_BUCKETS_MS = 100, 2_000, 60_000


def points_in_fallback(
    points: DataFrame,
    intervals: DataFrame,
    longest_s: int = 600,
    delay: str = S.ALLOWED_DELAY,
) -> DataFrame:
    """The points of a stream whose time lies in a stretch of fallback mode.

    Both sides are streams and may come in any order within the delay: a point waits in the state
    for the stretch that it lies in, which is known only after its end, and a stretch for its
    points. Stretches are at most `longest_s` seconds long, so a point is let go once the watermark
    of the stretches is past that. `points` has `time_ms`; `intervals` (from_us, until_us,
    in_fallback) are those of one monitor, so short ones are many and long ones few.
    """
    met = [F.struct(F.lit(b).alias("_size"), F.floor(F.col("time_ms") / b).alias("_bucket")) for b in JOIN_BUCKETS_MS]
    timed = points.withColumn("_met", F.explode(F.array(*met))).withColumn("_at", F.timestamp_millis("time_ms"))
    timed = timed.withWatermark("_at", delay)
    first, last = (F.floor(F.col(c) / 1_000) for c in ("from_us", "until_us"))
    *shorter, longest = JOIN_BUCKETS_MS
    size = F.coalesce(*[F.when(last - first <= b, b) for b in shorter], F.lit(longest))
    ended = intervals.filter("in_fallback").filter(last > first).select(
        first.alias("_from"),
        last.alias("_until"),
        F.timestamp_millis(last).alias("_end"),
        size.alias("_long"),
        # a stretch is laid into each bucket that it touches, as the streams meet by equal buckets
        F.explode(
            F.sequence(
                F.floor(F.greatest(first, last - longest_s * 1_000) / size), F.floor((last - 1) / size)
            )
        ).alias("_touched"),
    )
    ended = ended.withWatermark("_end", delay)
    inside = (F.col("time_ms") >= F.col("_from")) & (F.col("time_ms") < F.col("_until"))
    near = (F.col("_at") <= F.col("_end")) & (F.col("_at") >= F.col("_end") - F.expr(f"interval {longest_s} seconds"))
    same = (F.col("_met._size") == F.col("_long")) & (F.col("_met._bucket") == F.col("_touched"))
    return timed.join(ended, same & inside & near).select(*points.columns)


def mode_state(spark: SparkSession, checkpoint: str, key: str = "pipeline") -> DataFrame:
    """(key, in_fallback, violation_count) as of the last micro-batch of `fallback_state_stream`."""
    state = spark.read.format("statestore").option("stateVarName", "mode").load(checkpoint)
    return state.select(
        F.col("key")[key].alias(key), F.col("value.in_fallback"), F.col("value.violation_count")
    )


# ---- the last readings -------------------------------------------------------------------


class _History(StatefulProcessor):
    """The last readings of one person, oldest first."""

    def __init__(self, names: Sequence[str], columns: Sequence[str], order: Sequence[str], size: int, present: str):
        self.columns, self.order, self.size = list(columns), list(order), size
        self.present = self.columns.index(present)
        self.names = list(names)
        added = [f"{kind}_{c}" for c in columns for kind in ("mean", "delta")]
        self.row = Row(*names, *added, "n_history")

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"v{i} double" for i in range(len(self.columns)))
        self.ring = handle.getListState("ring", fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = self.ring.get() if self.ring.exists() else ()
        ring = deque((tuple(r) for r in kept), maxlen=self.size)
        for row in _sorted(rows, self.order):
            values = tuple(None if row[c] is None else float(row[c]) for c in self.columns)
            ring.append(values)
            shown: list[float | None] = []
            usable = [r for r in ring if r[self.present] is not None]
            for i, value in enumerate(values):
                known = [r[i] for r in usable if r[i] is not None]
                mean = sum(known) / len(known) if known else None
                shown += [mean, None if mean is None or value is None else value - mean]
            yield self.row(*[row[c] for c in self.names], *shown, len(usable))
        self.ring.put(list(ring))


def history_stream(
    readings: DataFrame,
    columns: Sequence[str] = ("HR", "TEMP", "EDA", "Z"),
    key: str = "id",
    order: Sequence[str] = ("seq",),
    size: int = S.HISTORY,
    present: str = "HR",
) -> DataFrame:
    """Each reading of a stream with the mean of the person's last `size` readings, itself included,
    and its distance from it.

    A ring of `size` readings a person is kept; older ones go as new ones come. As in
    `operators.windows.delta_vs_history_mean`, readings without `present` take a place in the ring
    but no part in the mean, and missing values are left out; `n_history` counts those that do.
    """
    added = [(f"{kind}_{c}", T.DoubleType()) for c in columns for kind in ("mean", "delta")]
    return readings.groupBy(key).transformWithState(
        statefulProcessor=_History(readings.columns, columns, order, size, present),
        outputStructType=_with_fields(readings.schema, *added, ("n_history", T.LongType())),
        outputMode="Append",
        timeMode="None",
    )
