"""Reading the given tables, row keys, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import work_dir


# Workers outlive their tasks; these make them hand freed arrays back to the system at once.
_GIVE_BACK = {
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "1048576",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package, wherever the driver started,
    and keep no memory that they do not use.

    Elsewhere the package comes with ``--py-files`` or is installed.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    for name, value in _GIVE_BACK.items():
        env.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to a table in the shared folder and read again.

    Cuts the lineage: a lost executor costs recomputed tasks of the next step only.
    The session removes the folder when it ends.
    """
    path = work_dir(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


#: Bits of a row number; the operators that derive further numbers from one have the rest.
_ROW_BITS = 60


def scan(df: DataFrame) -> DataFrame:
    """``df`` if it is a scan of stored files, else its rows stored in the shared folder.

    A function that numbers the same rows more than once takes this first.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    hidden = plan.metadataOutput() if plan.children().isEmpty() else plan.output().take(0)
    if any(hidden.apply(i).name() == "_metadata" for i in range(hidden.size())):
        return df
    return stored(df, "scan")


def _plain_path(path: str) -> str:
    return re.sub(":/+", ":/", path)


def _file_bits(files: list[str]) -> tuple[int, str]:
    """How many bits of a salted path hash tell the files apart, and the salt."""
    bits = 0 if len(files) < 2 else 2 * (len(files) - 1).bit_length()
    for n in range(1000):
        salt = f"#{n}"
        hashes = {xxhash.xxh64_intdigest(_plain_path(f) + salt, seed=42) & ((1 << bits) - 1) for f in files}
        if len(hashes) == len(files):
            return bits, salt
    raise ValueError("no hash tells the files apart")


def numbered(df: DataFrame, row: str = "_row") -> DataFrame:
    """A number for each row, the same on every read whatever the splits or the cluster's size.

    It is made of the row's place in its file and a hash of the file's path, so rows that
    stand together in a file have numbers that do. What is not a scan of stored files, at
    most with columns or filters on it, is stored first. A file may have 2^60 rows divided
    by the square of the number of files; beyond that the read fails.
    """
    df = scan(df)
    files = df.inputFiles()
    bits, salt = _file_bits(files) if files else (0, "")
    at, path = df.metadataColumn("_metadata")["row_index"], df.metadataColumn("_metadata")["file_path"]
    room = 1 << (_ROW_BITS - bits)
    place = F.when(at < room, at).otherwise(F.raise_error(F.lit("a file has too many rows to number")).cast("long"))
    if not bits:
        return df.withColumn(row, place)
    path = F.concat(F.regexp_replace(path, ":/+", ":/"), F.lit(salt))
    file = F.xxhash64(path).bitwiseAND(F.lit((1 << bits) - 1))
    return df.withColumn(row, file * F.lit(room) + place)


def few(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, so that not all its texts are Python strings at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _trim() -> None:
    """The C library's freed memory to the system, also where used pieces lie behind it."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: What lets go of memory that a worker keeps from task to task of a stage.
_LET_GO: list[Callable[[], None]] = []


def let_go() -> None:
    """For tasks that have no use for what this worker keeps for tasks of earlier stages."""
    for drop in _LET_GO:
        drop()
    _trim()


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for the batches of a task; its worker, which waits for other stages' tasks from
    then on, keeps no memory that the task had."""

    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        _trim()

    return task


def id_as_text(df: DataFrame, name: str) -> DataFrame:
    """Ids on their way to pandas, which would turn a column with nulls to doubles."""
    return df.withColumn(name, F.col(name).cast("string"))


def id_as_long(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("long"))


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_row, <id>, text)`` with null texts as empty ones; other columns go."""
    picked = df.select(
        F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    return numbered(picked)


def smallest(df: DataFrame, by: Column, n: int) -> DataFrame:
    """The rows whose ``by``, a hash, is among the ``n`` smallest distinct ones.

    Only hashes travel to find the limit, so a task hands on ``n`` numbers, not ``n`` rows.
    """
    limit = df.select(by.alias("h")).distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.where(by <= limit) if limit is not None else df.limit(0)
