"""Processing lag, and handing over between the primary and the fallback.

The monitor is a small state machine per pipeline, and a pipeline's checks may be most of the
table. So the checks are shuffled once into range partitions of (pipeline, order). Inside one,
running sums and maxima tell everything about the machine but what it was when the partition
began; one row per partition carries that forward.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.operators.filters import Moment, epoch_ms, recent_range
from vitalflow.operators.ordered import (
    fold_runs,
    hand_on,
    in_runs,
    key_so_far,
    running_before,
    with_carry,
)
from vitalflow.session import staged


def processing_lag(
    points: DataFrame, as_of: Moment = None, lookback_ms: int = S.LAG_LOOKBACK_MS
) -> DataFrame:
    """Seconds between `as_of` and the newest processed time; null without recent points."""
    newest = recent_range(points, lookback_ms, as_of).agg(F.max("time_ms").alias("last_ms"))
    return newest.select("last_ms", ((epoch_ms(as_of) - F.col("last_ms")) / 1000.0).alias("lag_s"))


def lag_by_source(
    points: DataFrame, as_of: Moment = None, lookback_ms: int = S.LAG_LOOKBACK_MS
) -> DataFrame:
    newest = recent_range(points, lookback_ms, as_of).groupBy("source")
    return newest.agg(F.max("time_ms").alias("last_ms")).withColumn(
        "lag_s", (epoch_ms(as_of) - F.col("last_ms")) / 1000.0
    )


def check_flags(checks: DataFrame, limit_s: float, resume_share: float) -> DataFrame:
    """Add `breach`, `reset` and `_stop`, what a check does to the monitor."""
    lag = F.col("latency_s")
    healthy = F.coalesce(F.col("healthy"), F.lit(False))
    late = F.coalesce(lag > limit_s, F.lit(False))
    resumes = F.coalesce((lag != 0) & (lag < limit_s * resume_share), F.lit(False))
    return checks.withColumns(
        {
            "breach": ~healthy | late,
            "reset": healthy & ~late & lag.isNotNull(),
            "_stop": healthy & resumes,
        }
    )


def _told(
    checks: DataFrame, key: str, order: str, limit_s: float, resume_share: float, violations: int
) -> DataFrame:
    """Checks with what their partition tells of the machine, and what earlier ones hand on.

    `_run` counts the breaches since the last reset in the partition, or since it began;
    `_opening` is the largest such count before its first reset, to which the breaches of earlier
    partitions add up. `_fired` and `_stopped` say whether the partition has set or cleared the
    mode. `_open`, `_mode` and `_stretch` are the breaches still counted, the mode and the number
    of resets when the partition begins.
    """

    def compute(columns: Mapping[str, pa.ChunkedArray], starts: np.ndarray) -> dict[str, object]:
        def flag(name: str) -> np.ndarray:
            return columns[name].combine_chunks().to_numpy(zero_copy_only=False).astype(bool)

        def newest(places: np.ndarray, where: np.ndarray) -> np.ndarray:
            """The largest of `places` so far in the run among the rows marked, else -1."""
            marked = pa.chunked_array([pa.array(np.where(where, places, -1))])
            return fold_runs(marked, starts, "max")[1].to_numpy(zero_copy_only=False)

        def total(where: np.ndarray) -> np.ndarray:
            counts = pa.chunked_array([pa.array(where.astype(np.int64))])
            return fold_runs(counts, starts, "sum")[1].to_numpy(zero_copy_only=False)

        def before(values: np.ndarray) -> pa.Array:
            first = np.zeros(len(values), dtype=bool)
            first[starts] = True
            return pa.array(np.roll(values, 1), mask=first)

        breaches, resets = total(flag("breach")), total(flag("reset"))
        run = breaches - np.maximum(newest(breaches, flag("reset")), 0)
        rows = np.arange(len(run))
        opening = np.maximum(newest(run, resets == 0), 0)
        last_stop, last_start = newest(rows, flag("_stop")), newest(rows, run >= violations)
        fired, stopped = last_start > last_stop, last_stop >= 0
        return {
            "_run": run, "_resets": resets, "_opening": opening, "_fired": fired,
            "_stopped": stopped, "_was_opening": before(opening), "_was_fired": before(fired),
            "_was_stopped": before(stopped),
        }

    counts, flags = ("_run", "_resets", "_opening", "_was_opening"), ("_fired", "_stopped")
    fields = [T.StructField(n, T.LongType()) for n in counts] + [
        T.StructField(p + n, T.BooleanType()) for n in flags for p in ("", "_was")
    ]
    flagged = check_flags(checks, limit_s, resume_share)
    rows = in_runs(flagged, [key], [order], compute, fields, "monitor")

    so_far = key_so_far([key])
    ends = rows.filter("_end").withColumn("_all", F.sum("_run").over(so_far))
    # a partition with a reset starts the count anew with its own tail
    base = F.max(F.when(F.col("_resets") > 0, F.col("_all") - F.col("_run"))).over(so_far)
    ends = ends.withColumn("_open", F.col("_all") - F.coalesce(base, F.lit(0)))
    opened = F.coalesce(
        F.lag("_open").over(Window.partitionBy(key).orderBy("_part")), F.lit(0)
    )
    # what a partition makes of the mode: sets it, clears it, or (null) leaves it as it was
    sets = F.col("_fired") | (~F.col("_stopped") & (F.col("_opening") + opened >= violations))
    ends = ends.withColumn("_effect", F.when(sets, True).when(F.col("_stopped"), False))
    ends = ends.withColumns(
        {
            "_mode": F.last("_effect", ignorenulls=True).over(so_far),
            "_stretch": F.sum("_resets").over(so_far),
        }
    )
    nothing = {"_open": F.lit(0), "_mode": F.lit(False), "_stretch": F.lit(0)}
    joined = with_carry(rows, [key], hand_on(ends, [key], list(nothing)))
    return joined.withColumns({c: F.coalesce(c, none) for c, none in nothing.items()})


def violation_runs(
    checks: DataFrame,
    key: str = "pipeline",
    order: str = "seq",
    limit_s: float = S.LAG_LIMIT_S,
) -> DataFrame:
    """Add `run`, the breaches since the last good check, and `run_id`, the stretch it belongs to.

    An unhealthy check or a lag over the limit is a breach. A healthy check without a lag
    neither adds nor resets. Checks without a key form a pipeline of their own.
    """
    rows = _told(checks, key, order, limit_s, S.RESUME_SHARE, S.VIOLATIONS)
    return rows.select(
        *checks.columns,
        "breach",
        "reset",
        (F.col("_stretch") + F.col("_resets")).alias("run_id"),
        (F.col("_run") + F.when(F.col("_resets") == 0, F.col("_open")).otherwise(0)).alias("run"),
    )


def fallback_state(
    checks: DataFrame,
    key: str = "pipeline",
    order: str = "seq",
    limit_s: float = S.LAG_LIMIT_S,
    violations: int = S.VIOLATIONS,
    resume_share: float = S.RESUME_SHARE,
) -> DataFrame:
    """Add `violation_count` and `in_fallback` after each check, and `was_fallback` before it.

    `violations` breaches with no reset between them start the fallback. A healthy check with a
    non-zero lag under `limit_s * resume_share` ends it and clears the count; breaches during
    the fallback count for nothing. Checks without a key form a pipeline of their own.
    """
    rows = _told(checks, key, order, limit_s, resume_share, violations)

    def mode_after(fired: Column, stopped: Column, opening: Column) -> Column:
        reached = opening + F.col("_open") >= violations
        return fired | (~stopped & (F.col("_mode") | reached))

    after = mode_after(F.col("_fired"), F.col("_stopped"), F.col("_opening"))
    before = F.when(F.col("_was_fired").isNull(), F.col("_mode")).otherwise(
        mode_after(F.col("_was_fired"), F.col("_was_stopped"), F.col("_was_opening"))
    )
    run = F.col("_run") + F.when(F.col("_resets") == 0, F.col("_open")).otherwise(0)
    return rows.select(
        *checks.columns,
        before.alias("was_fallback"),
        after.alias("in_fallback"),
        F.when(after, F.lit(0)).otherwise(run).cast("bigint").alias("violation_count"),
    )


def mode_timeline(
    states: DataFrame,
    key: str = "pipeline",
    order: str = "seq",
    time_us: str = "check_us",
) -> DataFrame:
    """One row per change of mode: TRIGGER or RESUME, until when, and for how long.

    The last mode of a pipeline is open: its end and duration are null. The changes are written
    to the shared folder first, as they are few and read several times.
    """
    changed = states.filter(F.col("was_fallback") != F.col("in_fallback"))
    changes = staged(changed.select(key, order, time_us, "in_fallback"), "mode-changes")
    backwards = running_before(
        changes,
        [key],
        [F.col(order).desc()],
        until_us=("min", F.col(time_us)),
    )
    return backwards.select(
        key,
        order,
        F.when(F.col("in_fallback"), "TRIGGER").otherwise("RESUME").alias("change"),
        F.col(time_us).alias("from_us"),
        "until_us",
        ((F.col("until_us") - F.col(time_us)) / 1_000_000.0).alias("duration_s"),
    )


def triggers_by_period(
    timeline: DataFrame, period_ms: int = 604_800_000, key: str = "pipeline"
) -> DataFrame:
    """Triggers and resumes of each pipeline per period."""
    ms = F.floor(F.col("from_us") / 1000).cast("bigint")
    period = (ms - F.pmod(ms, F.lit(period_ms).cast("bigint"))).alias("period_ms")
    return timeline.groupBy(key, period).agg(
        F.count_if(F.col("change") == "TRIGGER").alias("triggers"),
        F.count_if(F.col("change") == "RESUME").alias("resumes"),
    )


def dual_path_points(
    primary: DataFrame,
    fallback: DataFrame,
    timeline: DataFrame,
) -> DataFrame:
    """All primary points, and the fallback points of times in fallback mode.

    The mode at a point is that of the last change at or before it. Changes and points are laid
    on one time line and the last change is carried forward, so neither side is broadcast.
    `timeline` is that of one monitor; it is written once, as it is read several times.
    """
    columns = primary.columns
    kept = staged(timeline.select("from_us", "change"), "timeline")
    changes = kept.select(
        F.floor(F.col("from_us") / 1000).cast("bigint").alias("time_ms"),
        F.lit(0).alias("_kind"),
        F.col("from_us").alias("_at"),
        (F.col("change") == "TRIGGER").cast("int").alias("_mode"),
    )
    marked = fallback.withColumn("_kind", F.lit(1)).unionByName(changes, allowMissingColumns=True)
    carried = running_before(
        marked,
        [],
        ["time_ms", "_kind", "_at"],
        _last=("max", F.when(F.col("_kind") == 0, F.col("_at") * 2 + F.col("_mode"))),
    )
    during = carried.filter((F.col("_kind") == 1) & (F.pmod("_last", F.lit(2)) == 1))
    return primary.unionByName(during.select(*columns))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Newest minus committed offset per reader group and partition.

    `offsets` has rows (reader, partition, latest_offset, committed_offset), any of them partial.
    """
    per_partition = offsets.groupBy("reader", "partition").agg(
        F.max("latest_offset").alias("latest_offset"),
        F.max("committed_offset").alias("committed_offset"),
    )
    return per_partition.withColumn(
        "lag", F.col("latest_offset") - F.coalesce("committed_offset", F.lit(0))
    )


def consumer_lag_totals(per_partition: DataFrame) -> DataFrame:
    return per_partition.groupBy("reader").agg(
        F.sum("lag").alias("total_lag"), F.max("lag").alias("max_lag")
    )


def stress_alerts(scored: DataFrame, prediction: str = "stress_level") -> DataFrame:
    """Rows predicted as high stress."""
    return scored.filter(F.col(prediction) == 2)
