"""Correlation and classifier metrics, each from one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow import schemas as S


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = (*S.FEATURES, "label")
) -> DataFrame:
    """Pearson correlation of every pair over the complete rows, as rows (a, b, corr).

    The means come first, as one scalar subquery; then each pair needs a single sum of centred
    products. Spark's own `corr` keeps six numbers a pair, which is too wide to compile.
    """
    names = list(columns)
    rows = df.dropna(subset=names)
    means = rows.agg(F.struct(*[F.avg(c).alias(c) for c in names])).scalar()
    centred = rows.select(*[(F.col(c) - means.getField(c)).alias(c) for c in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = centred.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs])

    def total(a: str, b: str) -> Column:
        return F.col(f"`{'|'.join(sorted((a, b), key=names.index))}`")

    cells = []
    for a in names:
        for b in names:
            spread = F.sqrt(total(a, a)) * F.sqrt(total(b, b))
            corr = F.when(spread > 0, total(a, b) / spread)
            cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), corr.alias("corr")))
    return sums.select(F.inline(F.array(*cells)))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of right predictions among the rows that have a known label and prediction."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return _usable(df, label, prediction).agg(F.avg(hit).alias("accuracy"))


def _usable(
    df: DataFrame, label: str, prediction: str, classes: Sequence[int] = S.CLASSES
) -> DataFrame:
    """Rows whose label and prediction are both one of the classes; no other row is judged."""
    return df.filter(F.col(label).isin(*classes) & F.col(prediction).isin(*classes))


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    classes: Sequence[int] = S.CLASSES,
) -> DataFrame:
    """One row per class, also one that is never true; one count column per predicted class.

    Rows whose label or prediction is null or another class are left out.
    """
    y, p = F.col(label), F.col(prediction)
    cells = [(a, b) for a in classes for b in classes]
    sums = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"_{a}_{b}") for a, b in cells])
    rows = [
        F.struct(
            F.lit(a).alias("label"), *[F.col(f"_{a}_{b}").alias(f"predicted_{b}") for b in classes]
        )
        for a in classes
    ]
    return sums.select(F.inline(F.array(*rows)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def classification_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    classes: Sequence[int] = S.CLASSES,
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    A class with nothing to divide by scores 0. Rows whose label or prediction is null or another
    class are left out, as in `accuracy` and `confusion_matrix`.
    """
    y, p = F.col(label), F.col(prediction)
    sums = _usable(df, label, prediction, classes).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("hits"),
        *[F.count_if((y == c) & (p == c)).alias(f"tp_{c}") for c in classes],
        *[F.count_if(p == c).alias(f"pred_{c}") for c in classes],
        *[F.count_if(y == c).alias(f"true_{c}") for c in classes],
    )
    scored = sums.select(
        "*",
        *[_ratio(F.col(f"tp_{c}"), F.col(f"pred_{c}")).alias(f"precision_{c}") for c in classes],
        *[_ratio(F.col(f"tp_{c}"), F.col(f"true_{c}")).alias(f"recall_{c}") for c in classes],
        *[
            _ratio(2.0 * F.col(f"tp_{c}"), F.col(f"pred_{c}") + F.col(f"true_{c}")).alias(f"f1_{c}")
            for c in classes
        ],
    )

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"),
            support.cast("bigint").alias("support"),
        )

    def total(terms: list[Column]) -> Column:
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    scores = ("precision", "recall", "f1")
    present = total([F.when(F.col(f"pred_{c}") + F.col(f"true_{c}") > 0, 1).otherwise(0) for c in classes])
    macro = [_ratio(total([F.col(f"{m}_{c}") for c in classes]), present) for m in scores]
    weighted = [
        _ratio(total([F.col(f"{m}_{c}") * F.col(f"true_{c}") for c in classes]), F.col("n"))
        for m in scores
    ]
    hit_share = _ratio(F.col("hits"), F.col("n"))
    rows = [
        row(str(c), *[F.col(f"{m}_{c}") for m in scores], F.col(f"true_{c}")) for c in classes
    ] + [
        row("accuracy", hit_share, hit_share, hit_share, F.col("n")),
        row("macro avg", *macro, F.col("n")),
        row("weighted avg", *weighted, F.col("n")),
    ]
    return scored.select(F.inline(F.array(*rows)))


def multi_logloss(
    df: DataFrame,
    label: str = "label",
    probabilities: Sequence[str] = ("p0", "p1", "p2"),
    floor: float = 1e-15,
) -> DataFrame:
    """Mean -ln of the probability given to the true class.

    Rows whose label is null or none of the classes, or whose probability for it is null, are left
    out; without other rows the result is null.
    """
    true_p = F.when(F.lit(False), F.lit(0.0))
    for cls, name in zip(S.CLASSES, probabilities):
        true_p = true_p.when(F.col(label) == cls, F.col(name))
    return df.agg(F.avg(F.when(true_p.isNotNull(), -F.log(F.greatest(true_p, F.lit(floor))))).alias("logloss"))
