"""Session set-up and the shared work folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UCT", "Zulu"}


def build_session(app: str = "tierflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; everything else is the cluster's choice.

    The shuffle width is left to the caller: adaptive execution merges small
    partitions of batch jobs, while a stateful stream fixes it at first start.
    Stream state lives in RocksDB, outside the heap, and is saved as change logs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Updates of up to this size have their keys filter a large table before its shuffle.
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Event times without an offset are read in the session zone, so jobs insist on UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


@functools.cache
def _private_root(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="tierflow-")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Only a local session (tests) may go without the setting: its executors are
    threads of this process, so a temporary folder is shared by all of them.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _private_root(spark.sparkContext.applicationId)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path below :func:`shared_root`.

    The session's file system deletes the folder when the session ends.
    """
    path = f"{shared_root(spark)}/tierflow/{purpose}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)  # only what exists can be marked
    fs.deleteOnExit(hadoop_path)
    return f"{path}/data"
