"""The few file-system calls the table layout needs, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

SUCCESS = "_SUCCESS"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/{SUCCESS}")


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; empty if there is no such path."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path``, sorted; empty if there is no such path."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def complete(spark: SparkSession, paths: Sequence[str]) -> list[bool]:
    """Whether the write to each path was committed, asked side by side."""
    if len(paths) < 2:
        return [is_complete(spark, p) for p in paths]
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(lambda p: is_complete(spark, p), paths))


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def modified_at(spark: SparkSession, path: str) -> int:
    fs, p = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None if there is no such file."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the ``<prefix>=<n>`` folders in ``path``, ascending."""
    head = f"{prefix}="
    names = [d.removeprefix(head) for d in child_dirs(spark, path) if d.startswith(head)]
    return sorted(int(n) for n in names if n.isdigit())
