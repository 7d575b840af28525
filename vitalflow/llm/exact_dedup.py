"""Exact deduplication as a stateful stream.

The documents are written once as the content store; a stream then reads the digests. Its keyed
state lies on disk (RocksDB) and never expires: per digest it keeps the stable identifier (the
smallest id so far), the locator of that row in the content store, and the number of rows. Digests
are combined in each task before the shuffle, so a hot group costs a task one row. Every hit is then
confirmed on the full bytes, fetched from the content store; texts that share a digest and differ
are told apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import SPACE, numbered_rows, settings, text_of
from vitalflow.session import staged

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FILES_PER_BATCH = 1_000


def normalized(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def first_rows(content: DataFrame, path: str, files_per_batch: int) -> DataFrame:
    """Per digest the first row's place in the order and its locator, and the number of rows.

    `content` is the table at `path`. Every file is read once; a run that broke off goes on from
    its progress log, with the state as of its last micro-batch.
    """
    spark = content.sparkSession
    stream = (
        spark.readStream.schema(content.schema)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .parquet(f"{path}/rows")
    )
    state = stream.groupBy("digest").agg(F.min("place").alias("first"), F.count("*").alias("n"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/state/batch={batch}")

    spark_settings = {
        "spark__sql__streaming__stateStore__providerClass": ROCKSDB,
        "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
        # else every store sets 4 MB aside, however small its share of the digests
        "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",
    }
    with settings(spark, **spark_settings):
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{path}/progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    schema = "digest string, first struct<missing:boolean,id:bigint,row_key:bigint>, n bigint"
    written = spark.read.schema(f"{schema}, batch int").parquet(f"{path}/state")
    # an entry only ever gets an earlier first row and a larger count
    return written.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): the numbered rows of `docs`, and per row_key its group of equal texts.

    Texts are equal when they are after `normalized`; null counts as empty. Of a group the row
    with the smallest id stays (nulls last); among rows with the same id, the first read. Groups
    have `doc_id`, `digest`, `keep_key`, `keep_id`, `group_size` and `kept`. Other columns of any
    name pass through inside `row`. An empty table gives empty results.
    """
    spark = docs.sparkSession
    rows, path = numbered_rows(docs, "exact-rows")
    known = F.col("row").getField(text)
    number = F.col("row").getField(doc_id).cast("bigint")
    place = F.struct(
        number.isNull().alias("missing"), number.alias("id"), F.col("row_key").alias("row_key")
    )
    light = rows.select(digest(normalized(known)).alias("digest"), place.alias("place"))
    digests_path = f"{path}-digests"
    light.write.parquet(f"{digests_path}/rows")
    light = spark.read.schema(light.schema).parquet(f"{digests_path}/rows")
    first = staged(first_rows(light, digests_path, files_per_batch), "exact-first")

    # the hits, with their full bytes; equal texts meet per task before the shuffle
    hits = first.filter("n > 1").select("digest", F.col("first.row_key").alias("first_key"))
    told = light.join(hits, "digest").select("place", "digest")
    fetched = rows.join(told.withColumn("row_key", F.col("place.row_key")), "row_key")
    classes = staged(
        fetched.groupBy("digest", normalized(known).alias("norm")).agg(
            F.min("place").alias("first"), F.count("*").alias("n")
        ),
        "exact-classes",
    )
    differing = staged(
        classes.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1"),
        "exact-differing",
    ).select("digest")
    by_digest = light.join(first, "digest").join(differing, "digest", "left_anti")
    odd = differing.join(fetched.withColumn("norm", normalized(known)), "digest")
    by_text = odd.join(classes, ["digest", "norm"]).select("digest", "place", "first", "n")
    groups = by_digest.select("digest", "place", "first", "n").unionByName(by_text)
    return rows, groups.select(
        F.col("place.row_key").alias("row_key"),
        F.col("place.id").alias("doc_id"),
        "digest",
        F.col("first.row_key").alias("keep_key"),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("first.row_key") == F.col("place.row_key")).alias("kept"),
    )


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    rows, groups = exact_groups(docs, **options)
    gone = groups.filter(~F.col("kept")).select("row_key")
    return rows.join(gone, "row_key", "left_anti").select("row.*")
