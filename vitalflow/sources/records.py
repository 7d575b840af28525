"""Binary sensor records: eight nullable fields, one Avro datum per value, no container.

Spark's Avro functions do the work; their package must be on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalflow import schemas as S


def avro_available(spark: SparkSession) -> bool:
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception:  # noqa: BLE001 - any failure to load means it is absent
        return False
    return True


def encode_sensor_values(df: DataFrame) -> DataFrame:
    """Rows to (key, value): the person id as UTF-8 and the binary record."""
    from pyspark.sql.avro.functions import to_avro

    cast = df.select(*[F.col(f.name).cast(f.dataType) for f in S.SENSOR_RECORD.fields])
    value = to_avro(F.struct(*S.SENSOR_RECORD.names), S.AVRO_SCHEMA)
    return cast.select(F.col("id").cast("binary").alias("key"), value.alias("value"))


def decode_sensor_values(
    df: DataFrame, value: str = "value", mode: str = "PERMISSIVE"
) -> DataFrame:
    """Binary values to the eight columns; unreadable values are skipped, or fail (FAILFAST)."""
    return _read(df, value, mode).filter("_readable").select(*S.SENSOR_RECORD.names)


def decode_with_rejects(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The readable records, and the values that could not be read."""
    both = _read(df, value, "PERMISSIVE")
    good = both.filter("_readable").select(*S.SENSOR_RECORD.names)
    return good, both.filter(~F.col("_readable")).select("value")


def _read(df: DataFrame, value: str, mode: str) -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    raw = df.select(F.col(value).alias("value"))
    read = raw.withColumn("_r", from_avro(F.col("value"), S.AVRO_SCHEMA, {"mode": mode}))
    return read.select(
        *[F.col(f"_r.{c}").alias(c) for c in S.SENSOR_RECORD.names],
        F.col("_r").isNotNull().alias("_readable"),
        "value",
    )
