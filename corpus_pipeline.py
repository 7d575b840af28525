"""From raw documents to token ids: filter, deduplicate, mix, encode.

Each stage works on all rows that the one before it kept. Its input is read from Parquet and its
output written there again, so a lost executor costs no more than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitalflow.llm import exact_dedup, mixing, near_dedup, pieces, quality
from vitalflow.llm.common import documents, labels
from vitalflow.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality classifier rejects go."""
    return quality.keep_good(docs, labels(spark, sf_dir))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the one with the smallest id stays."""
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of texts linked by shingles of five words, alike to 0.8, one stays."""
    return near_dedup.near_dedup(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: every document as often as its source's target asks for."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: (doc_id, n_tokens, ids, exact) of every document."""
    return pieces.encode_documents(docs, public_tokenizers.path(pieces.MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("source_mixing", mixed),
    ("sentencepiece", encoded),
]

#: Trained weights, minhash and segmentation have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`, each written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
