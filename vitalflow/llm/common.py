"""Helpers of the operators in this package."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalflow.session import fresh_path

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; a null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold_of(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % F.lit(folds)


def numbered_rows(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`docs` written once as (row_key, row): `row` holds all columns, whatever their names.

    The number identifies a row even where ids repeat or are null, and keeps doing so when an
    executor is lost, as it is read back from the shared folder and never made again.
    """
    path = fresh_path(docs.sparkSession, name)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_key"), F.struct("*").alias("row")
    )
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path), path


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker and serves all its tasks."""
    module = sys.modules.setdefault(
        "vitalflow_worker_cache", types.ModuleType("vitalflow_worker_cache")
    )
    return module.__dict__.setdefault(name, {})


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (with `__` for a dot) while the block runs; then the old ones again."""
    before = {}
    for key, value in values.items():
        key = key.replace("__", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, old in before.items():
            spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def _store(path: str):
    """(file system, path inside it) of a path or URI, in the driver or a task."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def make_folder(folder: str) -> None:
    store, inner = _store(folder)
    store.create_dir(inner, recursive=True)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write one file into a shared folder from inside a task; the path it can be read by.

    The name gets a unique part, so that a repeated or speculative task never touches the file of
    another attempt; readers go by the paths of the attempts that count.
    """
    base, dot, ending = name.partition(".")
    path = f"{folder}/{base}-{uuid.uuid4().hex}{dot}{ending}"
    store, inner = _store(path)
    with store.open_output_stream(inner, compression=None) as out:
        out.write(data)
    return path


def read_files(paths: DataFrame, column: str, folder: str) -> DataFrame:
    """(path, content) of the files that `paths` names, one row each, read by Spark's own reader."""
    spark = paths.sparkSession
    found = spark.read.format("binaryFile").load(folder).select("path", "content")
    name = F.substring_index(F.col("path"), "/", -1)
    wanted = paths.select(F.substring_index(F.col(column), "/", -1).alias("_name")).distinct()
    return found.withColumn("_name", name).join(wanted, "_name", "left_semi").drop("_name")


def string_batches(
    batches: Iterator[pa.RecordBatch], column: str, rows: int = 256
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Small slices of the batches with the texts of one column, so that few are decoded at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(part.schema.get_field_index(column)).to_pylist()
