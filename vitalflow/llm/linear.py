"""Naive Bayes support vectors over n-gram indicators.

Counts of the indicators per class come from a large bounded sample of the labelled training rows, as
one Spark aggregate over hashed features. Their log ratios scale the indicators; a linear hinge-loss model is then fitted by
dual coordinate descent on a bounded sample, and its margins are mapped to 0..1 by a logistic curve
fitted on margins of rows the respective model has not seen.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow.llm.common import text_of
from vitalflow.session import staged

#: Indicators are hashed into so many; a power of two.
FEATURES = 1 << 17
#: Labelled rows that are counted, about, if there are more.
SAMPLE_ROWS = 40_000
#: Those of them that the hinge-loss model is fitted on, about.
FIT_ROWS = 8_000

#: Feature numbers of each document of a text column: one sorted array without repeats each.
Extract = Callable[[pa.Array], Iterator[np.ndarray]]


@dataclass(frozen=True)
class LinearModel:
    """score = 1 / (1 + exp(-(slope * margin + shift))), margin = sum of `weights` + `bias`."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, features: np.ndarray) -> float:
        margin = float(self.weights[features].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35))))


def distinct_per_document(codes: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct feature numbers of each document out of codes laid end to end."""
    seen = np.zeros(FEATURES, dtype=bool)
    for at, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = codes[at:end]
        if len(own) < 2_000:
            yield np.unique(own)
            continue
        seen[own] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


def with_features(rows: DataFrame, extract: Extract) -> DataFrame:
    """(y, features) of labelled rows (y, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [f.astype(np.int32) for f in extract(batch.column(1))]
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["y", "features"])

    return rows.select("y", "text").mapInArrow(work, "y int, features array<int>")


def log_ratios(
    rows: DataFrame, extract: Extract, least: int, band: float
) -> tuple[np.ndarray, tuple[float, float]]:
    """Log ratio of each indicator's share in class 1 to that in class 0, and the class sizes.

    `rows` has (y, text). Indicators in fewer than `least` documents or with a ratio within `band`
    are set to 0. What comes to the driver is at most one row per feature number. Features are found
    and counted in one step, as every further one would take a Python process of its own per core,
    which stays with what it remembers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, FEATURES), dtype=np.int64)
        sizes = np.zeros(2, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for c, found in zip(y.tolist(), extract(batch.column(1)), strict=True):
                totals[c][found] += 1  # a document has each once
            for c in (0, 1):
                sizes[c] += int((y == c).sum())
        at = np.flatnonzero(totals.sum(axis=0))
        ids = np.concatenate([at, [-1]])
        both = np.concatenate([totals[:, at], sizes[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(both[0]), pa.array(both[1])], ["feature", "c0", "c1"]
        )

    counted = rows.select("y", "text").mapInArrow(count, "feature long, c0 long, c1 long").groupBy("feature").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1")
    )
    table = counted.toPandas()
    sizes = table[table.feature == -1][["c0", "c1"]].sum().to_numpy(dtype=float)
    table = table[table.feature >= 0]
    share1 = (table.c1 + 1) / (sizes[1] + 2)
    share0 = (table.c0 + 1) / (sizes[0] + 2)
    ratio = np.log(share1 / share0).where((table.c0 + table.c1 >= least), 0.0)
    ratio = ratio.where(ratio.abs() > band, 0.0)
    out = np.zeros(FEATURES)
    out[table.feature.to_numpy(dtype=np.int64)] = ratio.to_numpy()
    return out, (float(sizes[0]), float(sizes[1]))


def dual_coordinate_descent(
    rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float, epochs: int, seed: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised squared-hinge model on scaled indicators.

    Each step solves the dual problem exactly in one row's variable. `y` is +1 or -1.
    """
    draw = np.random.default_rng(seed)
    weights, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    damp = 1 / (2 * cost)
    norms = np.array([float(v @ v) + 1.0 for v in values]) + damp
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            margin = float(weights[rows[i]] @ values[i]) + bias
            step = max(alpha[i] - (y[i] * margin - 1 + damp * alpha[i]) / norms[i], 0.0) - alpha[i]
            if abs(step) > 1e-12:
                alpha[i] += step
                weights[rows[i]] += step * y[i] * values[i]
                bias += step * y[i]
    return weights, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margins to shares of class 1, by Newton's method."""
    slope, shift = 1.0, 0.0
    # targets kept off 0 and 1, as usual for few rows
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    wanted = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -35, 35)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - wanted) * margins).sum(), (p - wanted).sum()])
        hess = np.array(
            [[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]]
        )
        move = np.linalg.solve(hess, grad)
        slope, shift = slope - np.clip(move[0], -2, 2), shift - np.clip(move[1], -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return max(float(slope), 1e-3), float(shift)


def fit(
    labelled: DataFrame,
    extract: Extract,
    fit_rows: int = FIT_ROWS,
    cost: float = 1.0,
    epochs: int = 15,
    folds: int = 4,
    least: int = 3,
    band: float = 0.0,
    seed: int = 5,
) -> LinearModel:
    """The model for labelled rows (y 0 or 1, text, key); rows with another label are left out.

    All rows are counted, equal texts once; the hinge-loss model sees the rows whose hashed key
    falls under `fit_rows` over their number. Without rows of both classes the score is the share of class 1.
    """
    known = labelled.filter("y in (0, 1)").select(F.col("y").cast("int").alias("y"), "text", "key")
    known = staged(known.groupBy("text").agg(F.max("y").alias("y"), F.min("key").alias("key")), "fit-rows")
    ratios, sizes = log_ratios(known, extract, least, band)
    total = sum(sizes)
    if not min(sizes):
        share = (sizes[1] + 1) / (total + 2)
        return LinearModel(np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    part = min(1.0, fit_rows / total)
    chosen = F.pmod(F.xxhash64(F.coalesce("key", F.lit(-1)), F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20))
    sample = with_features(known.filter(chosen), extract)

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        kept = np.flatnonzero(ratios)
        order = np.lexsort((frame["features"].map(len).to_numpy(), frame["y"].to_numpy()))
        frame = frame.iloc[order]
        y = np.where(frame["y"].to_numpy() == 1, 1, -1)
        rows = [np.intersect1d(f, kept, assume_unique=True) for f in frame["features"]]
        fold = np.arange(len(y)) % folds
        margins = np.zeros(len(y))
        for k in range(folds):
            own = np.flatnonzero(fold != k)
            w, b = dual_coordinate_descent([rows[i] for i in own], y[own], ratios, cost, epochs, seed)
            for i in np.flatnonzero(fold == k):
                margins[i] = float(w[rows[i]] @ ratios[rows[i]]) + b
        slope, shift = logistic_curve(margins, y)
        w, b = dual_coordinate_descent(rows, y, ratios, cost, epochs, seed)
        packed = base64.b64encode((w * ratios).astype("<f8").tobytes()).decode()
        return pd.DataFrame({"w": [packed], "b": [b], "slope": [slope], "shift": [shift]})

    schema = "w string, b double, slope double, shift double"
    found = sample.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(solve, schema).first()
    return LinearModel(np.frombuffer(base64.b64decode(found.w)), found.b, found.slope, found.shift)


def scored(docs: DataFrame, extract: Extract, model: LinearModel, cut: float) -> DataFrame:
    """`docs` (with `text`, nulls already replaced) with `score` and `predicted`, other columns kept."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            score = np.array([model.score(f) for f in extract(batch.column(at))], dtype=float)
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(c for _, c in rest), pa.array(score), pa.array((score >= cut).astype(np.int32))],
                [*(n for n, _ in rest), "score", "predicted"],
            )

    return docs.mapInArrow(work, T.StructType([*kept, *added]))


def labelled_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Callable[[Column], Column],
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 11,
) -> DataFrame:
    """(key, y, text) of labelled documents that may be learnt from.

    `learn` tells, from an id, whether its label may be used. Of those labels about `sample_rows`
    at most are taken, by a hash of the id; being so bounded they are broadcast, and no text is
    shuffled to meet its label. Where an id has several labels the smallest counts; labels that are
    null or neither 0 nor 1, or have no document, are left out.
    """
    y = F.col(label).cast("int")
    usable = labels.filter(y.isin(0, 1) & F.col("doc_id").isNotNull() & learn(F.col("doc_id")))
    part = min(1.0, sample_rows / max(usable.count(), 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int(part * (1 << 20))
    marks = usable.filter(drawn).groupBy(F.col("doc_id").alias("key")).agg(F.min(y).alias("y"))
    own = docs.select(F.col(doc_id).alias("key"), text_of(text).alias("text"))
    return own.join(F.broadcast(marks), "key").select("key", "y", "text")
