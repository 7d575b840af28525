"""Quality classifier: Naive Bayes support vectors over byte trigrams and repeated words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm import linear, words
from vitalflow.llm.common import fold_of, text_of

CUT = 0.3
_SHIFT = np.uint32(32 - (linear.FEATURES.bit_length() - 1))


def extract(column: pa.Array) -> Iterator[np.ndarray]:
    """Indicators of a text: its byte trigrams, and word n-grams that only say "the same word again"
    (twice, three and four times in a row). A text under three bytes has no trigram."""
    for _, _, data, offsets in words.chunks(column):
        wide = data.astype(np.uint32)
        codes = np.zeros(len(data), dtype=np.uint32)
        if len(data) > 2:
            codes[:-2] = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        codes = (codes * np.uint32(0x9E3779B1)) >> _SHIFT
        hashes, firsts = words.words(data, offsets)
        same = np.zeros(len(hashes) + 3, dtype=bool)
        same[: max(len(hashes) - 1, 0)] = hashes[1:] == hashes[:-1]
        runs = [same[:-3], same[:-3] & same[1:-2], same[:-3] & same[1:-2] & same[2:-1]]
        bounds = [(a, max(a, b - 2)) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        seen = np.zeros(linear.FEATURES, dtype=bool)
        for i, (at, end) in enumerate(bounds):
            own = codes[at:end]
            first, last = firsts[i], firsts[i + 1]
            again = [
                k for k, run in enumerate(runs) if run[first : max(first, last - 1 - k)].any()
            ]
            if len(own) < 2_000:
                found = np.unique(np.concatenate([own, np.array(again, dtype=np.uint32)]))
            else:
                seen[own] = True
                seen[again] = True
                found = np.flatnonzero(seen)
                seen[found] = False
            yield found


def quality_model(
    docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], **options
) -> linear.LinearModel:
    """The model learnt from the labelled documents whose ids `learn` allows."""
    return linear.fit(linear.labelled_rows(docs, labels, "quality", learn), extract, **options)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_fold: int = 0,
    cut: float = CUT,
    **options,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A document is held out when crc32 of its id as text, modulo `folds`, is `held_fold`; labels of
    such documents are never learnt from. Only the text is scored; null counts as empty, and an
    empty text gets the score of no indicators. Rows that repeat are scored each. Without usable
    labels all scores are equal. An empty table gives no rows.
    """
    def held(doc_id: Column) -> Column:
        return fold_of(doc_id, folds) == held_fold

    model = quality_model(docs, labels, lambda doc_id: ~held(doc_id), **options)
    rows = docs.select("doc_id", held(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    return linear.scored(rows, extract, model, cut)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT, **options) -> DataFrame:
    """The rows of `docs` that the classifier predicts as good, with all their columns.

    The model learns from all labelled documents; the row keeps its own columns in `row`, so that
    no name clashes with the score's.
    """
    model = quality_model(docs, labels, lambda doc_id: F.lit(True), **options)
    rows = docs.select(text_of().alias("text"), F.struct("*").alias("row"))
    return linear.scored(rows, extract, model, cut).filter("predicted = 1").select("row.*")
