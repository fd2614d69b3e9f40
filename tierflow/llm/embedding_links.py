"""Links between embeddings by a pigeonhole join over blocks of rotated dimensions.

A cosine of at least c is a squared distance of at most 2 - 2c between unit vectors. Cut
into blocks, at least one block must stay within its share of that distance, in
proportion to its dimensions. So each block is range-joined on its own: vectors are dealt
into cells as wide as the block's radius along the block's first direction, neighbouring
cells meet, and what is close enough in the block is verified over all dimensions. The
rotation puts the directions of most variance first in each block. A pair counts in the
block where it is relatively closest, so nothing is counted twice.

Equal vectors are one class. Cells that hold many vectors are split into chunks which meet
pairwise, each pair of chunks a task of bounded size. Tasks emit link counts and a
spanning forest of what they found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.tables import numbered, smallest, stored, table

STRIP = 512


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors that the rotation is fitted on; it shapes work, never results.
    ``chunk``: vectors of a cell that one task takes on each side."""

    cosine: float = 0.9
    blocks: int = 4
    sample: int = 2000
    chunk: int = 8192

    @property
    def limit(self) -> float:
        return 2 - 2 * self.cosine + 1e-9


@dataclass(frozen=True)
class Rotation:
    """Orthogonal axes for vectors of one size, and the axes of each block."""

    axes: np.ndarray
    blocks: tuple[np.ndarray, ...]
    limit: float

    @classmethod
    def fit(cls, sample: np.ndarray, size: int, s: Settings) -> Rotation:
        axes = np.eye(size)
        if len(sample) > 1:
            axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
        n = min(s.blocks, size)
        return cls(axes, tuple(np.arange(b, size, n) for b in range(n)), s.limit)

    def budget(self, block: int) -> float:
        return self.limit * len(self.blocks[block]) / len(self.axes)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return unit(x) @ self.axes

    def cells(self, z: np.ndarray) -> np.ndarray:
        """The cell of each vector in each block; they number at most 2 / radius + 2."""
        first = z[:, [b[0] for b in self.blocks]]
        width = np.sqrt([self.budget(b) for b in range(len(self.blocks))])
        return np.floor(first / width).astype(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very small or large numbers stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def join_chunks(left: pd.DataFrame, right: pd.DataFrame | None, block: int, r: Rotation, s: Settings):
    """Link counts and a spanning forest between two chunks, or within one if ``right`` is None."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    size = len(r.axes)
    x = np.frombuffer(b"".join(both["x"]), np.float64).reshape(-1, size)
    y, z = unit(x), r.apply(x)
    inner = z[:, r.blocks[block]].astype(np.float32)
    norm = (inner * inner).sum(1)
    n, n_left = len(both), len(left)
    weight = both["n"].to_numpy()
    links = np.zeros(n, np.int64)
    forest_a, forest_b = [], []
    from_ = 0 if right is None else n_left
    budgets = np.array([r.budget(b) for b in range(len(r.blocks))])
    for at in range(0, n_left, STRIP):
        strip = np.arange(at, min(at + STRIP, n_left))
        start = at if right is None else from_
        near = norm[strip, None] + norm[None, start:] - 2 * (inner[strip] @ inner[start:].T)
        i, j = np.nonzero(near <= r.budget(block) + 1e-4)
        i, j = strip[i], j + start
        if right is None:
            i, j = i[i < j], j[i < j]
        kept_a, kept_b = [], []
        for k in range(0, len(i), 1 << 16):  # candidates are verified a bounded number at a time
            a, b = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            close = (y[a] * y[b]).sum(1) >= s.cosine
            a, b = a[close], b[close]
            gap = (z[a] - z[b]) ** 2
            share = np.stack([gap[:, c].sum(1) for c in r.blocks], 1) / budgets
            here = share.argmin(1) == block
            kept_a.append(a[here])
            kept_b.append(b[here])
        a, b = (np.concatenate(k) if k else np.empty(0, np.int64) for k in (kept_a, kept_b))
        links += np.bincount(a, weight[b], n).astype(np.int64) + np.bincount(b, weight[a], n).astype(np.int64)
        label = _labels(n, a, b)
        moved = np.flatnonzero(label != np.arange(n))
        forest_a.append(moved)
        forest_b.append(label[moved])
    a, b = np.concatenate(forest_a), np.concatenate(forest_b)
    label = _labels(n, a, b)
    node = both["class"].to_numpy()
    touched = np.flatnonzero(links > 0)
    return pd.DataFrame({"class": node[touched], "n_links": links[touched], "root": node[label[touched]]})


def _copies(class_: int, cell: int, n_chunks: dict[tuple[int, int], int], block: int, chunk_of) -> Iterator[tuple]:
    """The tasks a vector takes part in: (cell, is_guest_task, i, j, side)."""
    here = n_chunks[block, cell]
    own = chunk_of(class_, here)
    for j in range(own, here):
        yield cell, False, own, j, 0
    for i in range(own):
        yield cell, False, i, own, 1
    for i in range(n_chunks.get((block, cell - 1), 0)):
        yield cell, True, i, own, 1
    for j in range(n_chunks.get((block, cell + 1), 0)):
        yield cell + 1, True, own, j, 0


def _links_of_size(vectors: DataFrame, size: int, s: Settings) -> DataFrame:
    """``(class, n_links, root)`` from all tasks, for the vectors of one size."""
    spark = vectors.sparkSession
    vectors = vectors.where(F.size("v") == size).select("class", "n", "v")
    sample = smallest(vectors, F.xxhash64("class"), s.sample).orderBy("class").select("v").toPandas()["v"]
    sample = unit(np.stack(sample.to_list()))
    rotation = Rotation.fit(sample, size, s)

    def place(batches):
        for batch in batches:
            x = np.stack(batch["v"].to_list()).astype(np.float64)
            yield pd.DataFrame(
                {
                    "class": batch["class"],
                    "n": batch["n"],
                    "x": [v.tobytes() for v in x],
                    "cells": list(rotation.cells(rotation.apply(x))),
                }
            )

    placed = stored(vectors.mapInPandas(place, "class long, n long, x binary, cells array<long>"), "cells")
    counts = placed.select(F.posexplode("cells").alias("block", "cell")).groupBy("block", "cell")
    counts = counts.agg(F.count(F.lit(1)).alias("n")).collect()  # cells are bounded by 2 / radius
    n_chunks = {(r["block"], r["cell"]): -(-r["n"] // s.chunk) for r in counts}

    def deal(batches):
        for batch in batches:
            rows = []
            for class_, n, x, cells in zip(batch["class"], batch["n"], batch["x"], batch["cells"], strict=True):
                for block, cell in enumerate(cells):
                    for copy in _copies(class_, int(cell), n_chunks, block, lambda c, k: hash((c, 7)) % k):
                        rows.append((block, *copy, class_, n, x))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=DEALT)
                    rows = []
            yield pd.DataFrame(rows, columns=DEALT)

    def meet(task: pd.DataFrame) -> pd.DataFrame:
        block, is_guest = int(task["block"].iloc[0]), bool(task["guest"].iloc[0])
        left, right = (task[task["side"] == k].reset_index(drop=True) for k in (0, 1))
        if not is_guest and task["i"].iloc[0] == task["j"].iloc[0]:
            return join_chunks(left, None, block, rotation, s)
        if left.empty or right.empty:
            return pd.DataFrame({"class": [], "n_links": [], "root": []}, dtype="int64")
        return join_chunks(left, right, block, rotation, s)

    dealt = placed.mapInPandas(
        deal,
        "block int, cell long, guest boolean, i int, j int, side int, class long, n long, x binary",
    )
    tasks = dealt.groupBy("block", "cell", "guest", "i", "j")
    return tasks.applyInPandas(meet, "class long, n_links long, root long")


DEALT = ["block", "cell", "guest", "i", "j", "side", "class", "n", "x"]


def embedding_links(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``(vec_id, embedding)``.

    Null, empty and zero vectors and such with null or non-finite components link with
    nothing and are their own component; vectors of different sizes do not link. Rows
    with the same id are vectors of their own. A component's id is the smallest id in it;
    ids that are null do not count, and a row whose component has no id is kept. Other
    columns are ignored; an empty table gives no rows.
    """
    v = F.col("v")
    rows = numbered(vectors.select("vec_id", F.col("embedding").alias("v")))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    usable = v.isNotNull() & finite & F.exists(v, lambda c: c != 0)
    rows = rows.withColumn("v", F.when(usable, F.transform(v, lambda c: c + 0.0)))
    good = rows.where("v IS NOT NULL")
    classes = stored(good.groupBy("v").agg(F.min("_row").alias("class"), F.count(F.lit(1)).alias("n")), "vectors")
    sizes = [r[0] for r in classes.select(F.size("v").alias("size")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        part = _links_of_size(classes, size, s)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.select("class", F.col("n").alias("n_links"), F.col("class").alias("root")).limit(0)
    found = stored(found, "links")
    groups = components(found, "class", "root")
    n_links = found.groupBy("class").agg(F.sum("n_links").alias("others"))
    summed = (
        classes.join(n_links, "class", "left")
        .join(groups, F.col("class") == F.col("node"), "left")
        .select(
            "v",
            (F.coalesce("others", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component"),
        )
    )
    linked = stored(
        rows.join(summed, "v", "left").select(
            "vec_id",
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component", "_row").alias("component"),
        ),
        "linked",
    )
    least = linked.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return linked.join(least, "component").select(
        "vec_id",
        "n_links",
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )


def op6_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))
