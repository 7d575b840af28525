"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The state store of keyed state: on disk, with room for several states a key.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else every store sets 4 MB of disk aside, however small its state
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_LOCAL_DIRS: dict[str, str] = {}
_STAGED: dict[str, set[str]] = {}


def build_session(name: str = "vitalflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **KEYED_STATE,
        "spark.ui.enabled": "false",
        # call-site capture costs more than building most of the plans here
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local-mode session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="vitalflow-")
        context.setCheckpointDir(_LOCAL_DIRS[context.applicationId])
    return _LOCAL_DIRS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses; `drop_staged` removes it."""
    path = f"{shared_folder(spark)}/vitalflow/{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def drop_staged(spark: SparkSession, keep: Collection[str] = ()) -> None:
    """Remove what this application has written to the shared folder, but for the paths to keep.

    Results that still read from there must have been written or collected before.
    """
    paths = _STAGED.get(spark.sparkContext.applicationId, set())
    for path in [p for p in paths if p not in keep]:
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove one path of `fresh_path` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
    _STAGED.get(spark.sparkContext.applicationId, set()).discard(path)


@contextmanager
def session_settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session while the block runs; then the old ones again."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, old in before.items():
            spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` below the shared folder and read it back: cuts lineage, survives lost executors.

    With a `path` of `fresh_path`, the caller can drop it when nothing reads it any more.
    """
    path = path or fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
