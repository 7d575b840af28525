"""CSV files, zipped CSV files and column headers."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalflow import schemas as S
from vitalflow.functions import scalars as fn

ROWS_PER_CHUNK = 50_000


def read_sensor_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = S.SENSOR_RECORD,
    extra: Sequence[T.StructField] = (),
) -> DataFrame:
    """CSV with a header; empty text is null, other text must fit the column's type."""
    full = T.StructType([*schema.fields, *extra])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_zipped_csv(archives: DataFrame, member: str | None = None) -> DataFrame:
    """Rows of the CSV `member` of each archive, as text columns cast to the sensor schema.

    `archives` has the columns of the binaryFile source, of which path and content are used.
    A missing member or column is an error, and so is text that is no number. With `member` None the archive's own `member` column names
    it. Archives are read in parallel; one archive is streamed in chunks, not held unpacked.
    """
    wanted = F.lit(member) if member is not None else F.col("member")
    text = T.StructType([T.StructField(c, T.StringType()) for c in S.SENSOR_RECORD.names])
    packed = archives.select("path", "content", wanted.alias("member"))
    rows = packed.mapInPandas(_unpack, text)
    return rows.select(
        *[fn.empty_as_null(c, "float").alias(c) for c in S.SENSORS],
        F.nullif("id", F.lit("")).alias("id"),
        F.nullif("datetime", F.lit("")).alias("datetime"),
    )


def _unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = S.SENSOR_RECORD.names
    for frame in frames:
        for path, content, member in zip(frame["path"], frame["content"], frame["member"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                if member not in archive.namelist():
                    raise FileNotFoundError(f"{member} not found in {path}")
                with archive.open(member) as raw:
                    chunks = pd.read_csv(
                        raw, dtype=str, keep_default_na=False, chunksize=ROWS_PER_CHUNK
                    )
                    for chunk in chunks:
                        if missing := sorted(set(names) - set(chunk.columns)):
                            raise ValueError(f"{member} in {path} has no column {', '.join(missing)}")
                        yield chunk[names]


def pack_csv(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Zip the rows of each key into one archive row (path, member, content).

    Keys must bound the rows of an archive, for instance person and block.
    """
    names = S.SENSOR_RECORD.names

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        member = f"{frame['id'].iloc[0]}.csv"
        text = io.StringIO()
        frame[names].to_csv(text, index=False, quoting=csv.QUOTE_MINIMAL)
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(member, text.getvalue())
        path = "-".join(str(frame[k].iloc[0]) for k in keys) + ".zip"
        return pd.DataFrame({"path": [path], "member": [member], "content": [packed.getvalue()]})

    return df.groupBy(*keys).applyInPandas(pack, "path string, member string, content binary")


def write_csv_per_id(df: DataFrame, path: str) -> None:
    """One folder of CSV files per person, with header and all record columns.

    Rows are rebalanced by person; adaptive execution splits the folder of a large person over
    several writers.
    """
    rows = df.select(*S.RECORD_COLUMNS, F.col("id").alias("person"))
    rows.hint("rebalance", F.col("person")).write.partitionBy("person").option(
        "header", True
    ).csv(path)


def canonical_header(name: str, names: Mapping[str, str] = S.HEADER_NAMES) -> str:
    """Strip leading marks, case and spaces, then map to the canonical column name."""
    plain = re.sub(r"^[^0-9a-z]+", "", name.strip().lower()).replace(" ", "")
    return names.get(plain, plain)


def normalize_headers(df: DataFrame, names: Mapping[str, str] = S.HEADER_NAMES) -> DataFrame:
    """Columns under canonical names: descriptive ones, or with `names=COLUMN_NAMES` those that
    `drop_incomplete`, the split and the models work on."""
    return df.toDF(*[canonical_header(c, names) for c in df.columns])
