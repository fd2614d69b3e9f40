"""Merging updates into a table that is unique by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.clean import latest_per_key


def _same_key(keys: Sequence[str], nulls_match: bool) -> Column:
    def equal(k: str) -> Column:
        left, right = F.col(f"t.{k}"), F.col(f"u.{k}")
        return left.eqNullSafe(right) if nulls_match else left == right

    return reduce(and_, [equal(k) for k in keys])


def _widen(df: DataFrame, other: DataFrame) -> DataFrame:
    """Adds the columns only ``other`` has, as nulls."""
    kinds = {f.name: f.dataType for f in other.schema.fields}
    missing = {c: F.lit(None).cast(kinds[c]) for c in other.columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def merge_replace(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    nulls_match: bool = False,
) -> DataFrame:
    """MERGE with update-all and insert-all: an update always replaces its match.

    Only the key columns of the updates are joined; Catalyst broadcasts them when
    they are small and sort-merges otherwise. As in SQL a null key matches nothing
    and is inserted, unless ``nulls_match`` (a deduplication key with optional
    parts needs it, or each rerun would insert the row again). ``updates`` must be
    unique by key.
    """
    kept = target.alias("t").join(
        updates.select(*keys).alias("u"), _same_key(keys, nulls_match), "left_anti"
    )
    return kept.unionByName(updates, allowMissingColumns=True)


def merge_newest(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    survivor: Sequence[str],
) -> DataFrame:
    """Keeps the newer of old and new row, whatever order batches arrive in.

    One shuffle of both sides. Applying a batch twice, or batches in another order,
    gives the same table. Rows that tie on ``survivor`` are ranked by the other columns in
    their order, so that no column is left to chance, the clock columns among them.
    """
    both = target.unionByName(updates, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in survivor]
    return latest_per_key(both, keys, [*[c for c in survivor if c in both.columns], *rest])


SIGN = "_sign"


def matched(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the table that an update is about. Where the updates are too large to be
    broadcast, Spark puts a Bloom filter of their keys before the table's shuffle."""
    return target.alias("t").join(updates.select(*keys).alias("u"), _same_key(keys, True), "left_semi")


def changes(
    old: DataFrame, updates: DataFrame, keys: Sequence[str], survivor: Sequence[str], mode: str = "newest"
) -> DataFrame:
    """What the updates do to the table: every row that comes, with ``_sign`` 1, and the row that
    it replaces, if there was one, with -1. Updates that lose to the old row are left out.

    ``old`` has the :func:`matched` rows. ``newest`` ranks as :func:`merge_newest` does, and of
    equal rows the old one stays; with ``replace`` the update always wins.
    """
    old, updates = _widen(old, updates), _widen(updates, old)
    both = old.withColumn(SIGN, F.lit(-1)).unionByName(updates.withColumn(SIGN, F.lit(1)))
    ranked = [c for c in survivor if c in old.columns and c not in keys]
    ranked += [c for c in old.columns if c not in ranked and c not in keys]
    order = [F.col(c).desc_nulls_last() for c in ranked] + [F.col(SIGN)]
    if mode == "replace":
        order = [F.col(SIGN).desc()]
    won = F.first(SIGN).over(Window.partitionBy(*keys).orderBy(*order))
    return both.withColumn("_won", won).where("_won = 1").drop("_won")


def with_changes(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after its :func:`changes`: rows replaced or added, all others as they are."""
    new = changed.where(F.col(SIGN) == 1).drop(SIGN)
    same = _same_key(keys, True)
    kept = target.alias("t").join(new.select(*keys).alias("u"), same, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def with_changes_in(
    cell: Column, target: DataFrame, changed: DataFrame, keys: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """:func:`with_changes` where many rows change: table and new rows are shuffled once, to
    ``group`` and ``cell``, and stay there, so that a task has rows of few groups.

    Both must follow from the key. Rows are unique by key on both sides, so none is hot.
    """
    new = changed.where(F.col(SIGN) == 1)
    both = target.withColumn(SIGN, F.lit(0)).unionByName(new, allowMissingColumns=True)
    dealt = both.withColumn("_cell", cell).repartition(*group, "_cell")
    # A window over more columns than rows are dealt by needs no shuffle of its own.
    window = Window.partitionBy(*group, "_cell", *keys).orderBy(F.col(SIGN).desc())
    ranked = dealt.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank", "_cell", SIGN)


def merge_newest_narrow(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    survivor: Sequence[str],
) -> DataFrame:
    """:func:`merge_newest` for updates far smaller than the table.

    With the updates broadcast the table is not shuffled at all: one pass
    replaces beaten rows where they lie, a second reads only the key columns to
    find which updates are new. Should the updates turn out too large for Catalyst
    to broadcast, the same joins run as sort-merge. Both sides must be unique by key.
    """
    target, updates = _widen(target, updates), _widen(updates, target)
    columns = target.columns
    ranked = [c for c in survivor if c in columns and c not in keys]
    rest = [c for c in columns if c not in ranked and c not in keys]

    def packed(df: DataFrame) -> DataFrame:
        return df.select(*keys, F.struct(*ranked, *rest).alias("_row"))

    same = _same_key(keys, nulls_match=True)
    matched = packed(target).alias("t").join(packed(updates).alias("u"), same, "left")
    current = matched.select(
        *[F.col(f"t.{k}") for k in keys],
        # Structs compare field by field with null as smallest; a missing update is skipped.
        F.greatest("t._row", "u._row").alias("_row"),
    ).select(*keys, "_row.*")

    known = (
        target.select(*keys).alias("t").join(updates.select(*keys).alias("u"), same, "left_semi")
    )
    added = updates.alias("t").join(known.alias("u"), same, "left_anti")
    return current.select(*columns).unionByName(added.select(*columns))
