"""Mixing sources to target weights by subset sums over document lengths.

Every source has a target number of words to fill with documents, each used a bounded
number of times. All that matters for it is how many documents of each length there are,
so a source is planned on its histogram of lengths: each length gives its share of the
target, one more of the longest that still fit bring the rest within a bound, and a
bounded-knapsack dynamic program picks numbers of documents by length whose sum is nearest
to what is left. Documents of a length are used equally often, but for some that are used
once more; which ones is decided by a seeded hash of their ids.

A source of W words has at most sqrt(2 W) different lengths, which bounds the histogram that
one task plans on. Documents themselves are counted, dealt and ranked over all tasks: a
length that very many documents have is cut into buckets of the hash first, so that only
one of them has to be ranked to the row.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.llm.tables import stored, table

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """``weights`` of the sources in their order, again from the start beyond the last;
    ``share``: words to take, of all there are; ``most``: times that a document may be used.

    ``exact``: up to this many words the rest of a budget is fitted exactly.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    share: Fraction = Fraction(3, 2)
    most: int = 2
    seed: int = 13
    exact: int = 1 << 20


# --- how many documents of each length -------------------------------------------


def nearest_sum(lengths: np.ndarray, counts: np.ndarray, goal: float, limit: int) -> np.ndarray:
    """How often to use each length, at most ``counts`` times, for a sum nearest to ``goal``.

    A bounded knapsack up to ``limit`` or a length beyond the goal: of every sum it notes the
    first step that reaches it, so that going back from a sum meets each step once at most.
    """
    used = np.zeros(len(lengths), np.int64)
    fits = [i for i in range(len(lengths)) if counts[i] and 0 < lengths[i] <= limit]
    if goal <= 0 or not fits:
        return used
    top = int(min(limit, np.ceil(goal) + max(lengths[i] for i in fits)))
    want = int(goal + 0.5)
    by = np.full(top + 1, -1, np.int32)  # the step that reached a sum first
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    steps = []
    for i in sorted(fits, key=lambda i: -int(lengths[i])):
        length = int(lengths[i])
        left, copies = min(int(counts[i]), top // length), 1
        while left and not (want <= top and reached[want]):
            take = min(copies, left)
            weight = take * length
            new = np.flatnonzero(reached[: top + 1 - weight] & ~reached[weight:]) + weight
            reached[new] = True
            by[new] = len(steps)
            steps.append((i, take, weight))
            left, copies = left - take, 2 * copies
    sums = np.flatnonzero(reached)
    at = int(sums[np.abs(sums - goal).argmin()])
    while at:
        i, take, weight = steps[by[at]]
        used[i] += take
        at -= weight
    return used


def fit_budget(lengths: np.ndarray, counts: np.ndarray, goal: float, s: Settings = Settings()) -> np.ndarray:
    """How many documents of each length to take for about ``goal`` words in all.

    Each length gives its share first, so the mix has the lengths that its source has.
    Where that comes no nearer than a word and all there is lies within ``exact``, as in a
    source of few documents, the sum decides alone.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if goal <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    taken = np.floor(counts * (min(goal / total, 1.0) * (1 - 1e-12))).astype(np.int64)
    rest = goal - int((taken * lengths).sum())
    # Rounding left less than one document of each length, so one more of some will do.
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= s.exact // 2:
            break
        if lengths[i] and counts[i] > taken[i] and rest - s.exact // 2 >= lengths[i]:
            taken[i] += 1
            rest -= int(lengths[i])
    taken += nearest_sum(lengths, counts - taken, rest, s.exact)

    def off(used: np.ndarray) -> float:
        return abs(int((used * lengths).sum()) - goal)

    if off(taken) >= 1 and total <= s.exact:
        other = nearest_sum(lengths, counts, goal, s.exact)
        return other if off(other) < off(taken) else taken
    return taken


# --- targets ---------------------------------------------------------------------


def _positions(df: DataFrame, by: str) -> DataFrame:
    """``position`` of each row, from 0, by the distinct values of ``by``, null last.

    The rows are range-sorted; only the partitions' counts come to the driver.
    """
    order = F.col(by).asc_nulls_last()
    parts = stored(df.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, at = [], 0
    for r in sizes:
        before.append((r["part"], at))
        at += r["n"]
    starts = df.sparkSession.createDataFrame(before, "part int, start long")
    inside = F.row_number().over(W.partitionBy("part").orderBy(order)) - 1
    ranked = parts.withColumn("position", inside).join(F.broadcast(starts), "part")  # a row for each partition
    return ranked.withColumn("position", F.col("position") + F.col("start")).drop("part", "start")


def targets(sizes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``source, source_size, target`` of every row of ``(source, source_size)``.

    The sources in code-point order, null last, share the words to take by their weights.
    None gets more than ``most`` times what it has; what it cannot use goes to the others by
    weight, again until none is above.
    """
    weights = F.array(*[F.lit(w) for w in s.weights])
    ranked = _positions(sizes, "source")
    weight = F.element_at(weights, (F.col("position") % len(s.weights) + 1).cast("int")).cast("decimal(38,0)")
    ranked = stored(ranked.select("source", "source_size", weight.alias("weight")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    size = F.col("source_size").cast("decimal(38,0)")
    above, n_above, unit = F.lit(False), 0, Fraction(0)
    while True:
        free = ranked.agg(
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.sum(F.when(above, F.col("source_size"))).alias("full"),
            F.count_if(above).alias("n"),
        ).first()
        if free["weight"] is None or (n_above and free["n"] == n_above):
            break
        n_above = free["n"]
        unit = (s.share * total - s.most * (free["full"] or 0)) / int(free["weight"])
        num, den = (F.lit(str(x)).cast("decimal(38,0)") for x in (unit.numerator, unit.denominator))
        above = F.col("weight") * num > size * s.most * den
        if not n_above and not ranked.where(above).limit(1).count():
            break
    num = F.lit(str(unit.numerator)).cast("decimal(38,0)")
    shared = (F.col("weight") * num).cast("double") / F.lit(float(unit.denominator))
    return ranked.select(
        "source", "source_size", F.when(above, F.col("source_size") * s.most).otherwise(shared).alias("target")
    )


# --- documents -------------------------------------------------------------------


def planned(lengths: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``passes`` and ``extra`` of every row of ``(source, size, n, source_size, target)``:
    how often all documents of that size are taken, and how many of them once more."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].to_numpy()
        used = fit_budget(rows["size"].to_numpy(), s.most * n, float(rows["target"].iloc[0]), s)
        return rows.assign(passes=used // n, extra=used % n)

    schema = lengths.select("*", F.lit(0).alias("passes"), F.lit(0).cast("long").alias("extra")).schema
    return lengths.groupBy("source").applyInPandas(run, schema)


def _given(docs: DataFrame) -> DataFrame:
    """``used``: how many of the ``m`` documents of each row are taken once more.

    Where some of a length are, its buckets of the hash are filled one after the other, and
    only within a bucket are documents ranked.
    """
    some = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    whole = docs.where(~some).withColumn("used", F.when(F.col("extra") > 0, F.col("m")).otherwise(0))
    group = ["source", "size"]
    part = docs.where(some).withColumn("bucket", F.pmod("h", "buckets"))
    counts = part.groupBy(*group, "bucket").agg(F.sum("m").alias("in_bucket"))
    behind = W.partitionBy(*group).orderBy("bucket")
    counts = counts.withColumn("earlier", F.sum("in_bucket").over(behind) - F.col("in_bucket"))
    counts = stored(counts, "buckets")
    p, c = part.alias("p"), counts.alias("c")
    same = F.col("p.source").eqNullSafe(F.col("c.source"))
    for name in ("size", "bucket"):
        same = same & (F.col(f"p.{name}") == F.col(f"c.{name}"))
    part = p.join(c, same).select("p.*", (F.col("extra") - F.col("c.earlier")).alias("quota"))
    # Rows that tie have one id and one size, so it does not matter which of them comes first.
    rank = W.partitionBy(*group, "bucket").orderBy("h", "doc_id", "split")
    before = F.sum("m").over(rank) - F.col("m")
    used = F.greatest(F.lit(0).cast("long"), F.least("m", F.col("quota") - before))
    part = part.withColumn("used", used).drop("bucket", "quota")
    return whole.unionByName(part)


def mix(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source`` for every row of ``(doc_id, text, source)``.

    ``size`` is the number of words, ``taken`` that many as often as the mix uses the
    document. A null or empty text has size 0 and nothing is taken; a null source is a source
    of its own, the last; null and repeated ids count as documents each. Other columns are
    ignored; an empty table gives no rows. The same rows give the same mix, whatever their
    files and order: of rows with the same id, source and size any may be the one used.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = documents.select("doc_id", "source", size.alias("size"), F.spark_partition_id().alias("split"))
    # Equal rows of a split are one, so no id is too frequent for a task.
    docs = rows.groupBy("source", "size", "doc_id", "split").agg(F.count(F.lit(1)).alias("m"))
    docs = stored(docs.withColumn("h", F.xxhash64(F.lit(s.seed), "doc_id")), "entries")
    lengths = docs.groupBy("source", "size").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("entries"))
    lengths = stored(lengths, "lengths")
    aims = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), s)
    same = F.col("l.source").eqNullSafe(F.col("a.source"))
    plan = lengths.alias("l").join(aims.alias("a"), same).select("l.*", "a.source_size", "a.target")
    # As many buckets as documents in each, so neither is too many for a task.
    plan = planned(plan, s).withColumn("buckets", F.ceil(F.sqrt("entries"))).drop("entries")
    plan = stored(plan, "plan")
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size"))
    docs = docs.alias("d").join(plan.alias("p"), same)
    docs = docs.select("d.*", *[f"p.{c}" for c in plan.columns if c not in ("source", "size")])
    dealt = _given(stored(docs, "dealt"))
    times = F.col("passes") + (F.col("number") <= F.col("used")).cast("int")
    return dealt.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), "source"
    )


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
