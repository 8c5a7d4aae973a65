"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# State outside the heap, committed as change logs.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tickguard", master: str | None = None, **settings) -> SparkSession:
    """A session with UTC time, adaptive execution and RocksDB stream state.

    Shuffle width is left to adaptive execution for tables; streams fix theirs
    through ``stream_session``.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STREAM_STATE,
        **{key.replace("__", "."): value for key, value in settings.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session whose shuffle width suits a stateful query.

    The width of stateful operators is frozen in the checkpoint at the first
    run, so it is set on a session of its own, away from the batch settings.
    By default it is the session's shuffle width, a setting; the cores that
    happen to have registered by now play no part.
    """
    width = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.shuffle.partitions", str(width))
    for key, value in STREAM_STATE.items():
        sibling.conf.set(key, value)
    return sibling


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it gets a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tickguard-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_dir(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_root(spark)}/tickguard/{label}-{uuid.uuid4().hex}"


_open_scope: ContextVar[list[str] | None] = ContextVar("settled_paths", default=None)


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor, computes the
    rows once however often they are used, and tells the optimizer their size.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    if (scope := _open_scope.get()) is not None:
        scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settled_for_now(spark: SparkSession):
    """Tables settled inside are removed at the end, so a long-running job leaves none behind."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            remove_folder(spark, path)


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, where = _located(spark, path)
    return files.exists(where)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path`` whose writer has finished, by name."""
    files, where = _located(spark, f"{path}/*/_SUCCESS")
    return sorted(found.getPath().getParent().toString() for found in files.globStatus(where) or [])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    files, where = _located(spark, path)
    files.delete(where, True)
