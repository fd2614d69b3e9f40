"""Tables in parts, as versions in the session's catalog.

A table's rows are dealt into a fixed number of parts by a hash of their key. Every version
``<name>_<n>`` is a partitioned table of the catalog whose parts lie where they were last
written; ``<name>`` is a view of the newest one, and its properties say what it holds. A
refresh writes only the parts that change, to a folder of its own, and replaces the
view, which readers see in one step. One writer per table at a time.

The catalog has to outlive the session, or versions are lost with it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources import files

PART = "part"
# Retention: versions that stay, the view's among them.
KEPT_VERSIONS = 2
_AT_ONCE = 500


@dataclass(frozen=True)
class Parted:
    """``view`` is ``<database>.<name>``; ``path`` is where the versions' folders lie."""

    view: str
    path: str

    def version(self, number: int) -> str:
        return f"{self.view}_{number}"

    def folder(self, number: int) -> str:
        return f"{self.path}/version={number}"


def part_of(keys: tuple[str, ...], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int").alias(PART)


def cell_of(keys: tuple[str, ...], cells: int) -> Column:
    """Deals the rows of a part further, by a hash that does not follow :func:`part_of`."""
    return F.pmod(F.xxhash64(F.lit("cell"), *keys), F.lit(cells))


def properties(spark: SparkSession, table: Parted) -> dict[str, str] | None:
    """What was said when the newest version was published; None if there is none."""
    if not spark.catalog.tableExists(table.view):
        return None
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table.view}").collect()}


def next_version(spark: SparkSession, table: Parted) -> int:
    """A number that no writer has used, be it a failed one."""
    return max(files.numbered(spark, table.path, "version"), default=0) + 1


def locations(spark: SparkSession, table: Parted, number: int) -> dict[int, str]:
    """Where the parts of a version lie."""
    found = {}
    for name in spark.table(table.version(number)).inputFiles():
        folder, part = re.fullmatch(rf"(.*/{PART}=(\d+))/[^/]*", unquote(name)).groups()
        found[int(part)] = folder
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(
    spark: SparkSession, table: Parted, number: int, schema: T.StructType, lie: Mapping[int, str], says: Mapping[str, str]
) -> None:
    """Makes a version of parts where they ``lie``, and the view of it."""
    name = table.version(number)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != PART]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.view.rsplit('.', 1)[0]} LOCATION {_quoted(table.path + '/catalog')}")
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(columns)}, {PART} int) USING parquet "
        f"PARTITIONED BY ({PART}) LOCATION {_quoted(table.folder(number) + '/rows')}"
    )
    lines = [f"PARTITION ({PART}={k}) LOCATION {_quoted(folder)}" for k, folder in sorted(lie.items())]
    for k in range(0, len(lines), _AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(lines[k : k + _AT_ONCE])}")
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in {**says, "version": str(number)}.items())
    shown = ", ".join(f"`{f.name}`" for f in schema.fields if f.name != PART)
    spark.sql(f"CREATE OR REPLACE VIEW {table.view} TBLPROPERTIES ({pairs}) AS SELECT {shown} FROM {name}")


def read_version(spark: SparkSession, table: Parted, number: int, parts: list[int]) -> DataFrame:
    """Some parts of a version, with their number; the others are not opened."""
    return spark.table(table.version(number)).where(F.col(PART).isin(parts))


def drop_old_versions(spark: SparkSession, table: Parted, keep: int = KEPT_VERSIONS) -> None:
    """Forgets all but the newest ``keep`` versions and deletes what none of those reads."""
    newest = int(properties(spark, table)["version"])
    database, name = table.view.rsplit(".", 1)
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}_*'").collect()]
    numbers = sorted(int(m[1]) for t in tables if (m := re.fullmatch(rf"{re.escape(name)}_(\d+)", t)))
    kept = [n for n in numbers if n <= newest][-keep:]
    if not kept or numbers[0] == kept[0]:
        return
    for number in numbers:
        if number < kept[0]:
            spark.sql(f"DROP TABLE {table.version(number)}")
    read = {folder for n in kept for folder in locations(spark, table, n).values()}
    used = {tuple(folder.rsplit("/", 3)[1:]) for folder in read}  # (version=<n>, rows, part=<k>)
    for number in files.numbered(spark, table.path, "version"):
        if number >= kept[0]:
            continue
        rows = f"{table.folder(number)}/rows"
        left = files.child_dirs(spark, rows)
        gone = [p for p in left if (f"version={number}", "rows", p) not in used]
        if len(gone) == len(left):
            files.delete(spark, table.folder(number))
            continue
        for p in gone:
            files.delete(spark, f"{rows}/{p}")
        files.delete(spark, f"{table.folder(number)}/changes")
