"""Hard negatives by window search in a multiway hyperplane tree.

For an anchor, its best rows of the same label are positives, and for each positive the best
rows of other labels whose score lies in a window below the positive's are hard negatives.
Scores are inner products of whole-numbered vectors. With one more coordinate, which makes
all rows equally long, a score is a distance: d^2 = |a|^2 + M^2 - 2 score, so a window of
scores is an annulus around the anchor.

The tree is laid out like a geometric near-neighbour access tree. Every node has a few split
points, a row goes to the nearest of them, and of each split point and each sibling's
subtree the least and largest distance are kept. A subtree is left out if for any split
point these distances, by the triangle inequality, leave nothing in the annulus; leaves are
searched exactly. Split points come from a bounded sample, the distances from all rows.

Each search has two passes: the anchor's own leaf first, whose finds narrow the window, then
what is left of the other leaves. Leaves lie in chunks and anchors in blocks; a task takes one
of each at a time. Of equal vectors with one label only the first few by id can ever be
among the best, so only these go into the tree, however many copies there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.llm.tables import numbered, smallest, stored, table

_FAR = 1 << 62


@dataclass(frozen=True)
class Settings:
    """``positives`` of an anchor, ``negatives`` of a positive; a negative scores from ``low``
    to ``high`` hundredths of the positive. Every ``anchor_every``-th id is an anchor.

    ``split`` points of a node, from ``sample`` rows; ``leaf`` rows aimed at; ``nodes`` at
    most. ``chunk`` rows of a leaf and ``block`` anchors meet at a time.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    anchor_every: int = 50
    split: int = 8
    sample: int = 4096
    leaf: int = 2048
    nodes: int = 1024
    chunk: int = 4096
    block: int = 512
    seed: int = 7


# --- the tree --------------------------------------------------------------------


@dataclass
class Node:
    """``children`` of each split point: a node's number, or ``-1 - leaf``; ``near`` and ``far``
    have for each split point (row) the distances of each subtree (column)."""

    points: np.ndarray
    children: list[int] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None


@dataclass
class Tree:
    """``reach`` is the length that all rows have with the added coordinate."""

    nodes: list[Node]
    leaves: int
    reach: float

    @property
    def slack(self) -> float:
        return 1e-6 * (self.reach + 1)

    def _added(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.reach**2 - (x * x).sum(1), 0))

    def distances(self, x: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Of rows to rows."""
        flat = (x * x).sum(1)[:, None] + (points * points).sum(1) - 2 * (x @ points.T)
        added = self._added(x)[:, None] - self._added(points)
        return np.sqrt(np.maximum(flat, 0) + added * added)

    def radius(self, anchors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Of anchors to rows that they have these scores with, a column for each score."""
        return np.sqrt(np.maximum((anchors * anchors).sum(1)[:, None] + self.reach**2 - 2.0 * scores, 0))

    def walk(self, x: np.ndarray, visit: Callable | None = None) -> np.ndarray:
        """The leaf of each row; ``visit(node, distances, child)`` sees the rows of each node."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            number, rows = todo.pop()
            far = self.distances(x[rows], self.nodes[number].points)
            child = far.argmin(1)
            if visit:
                visit(number, far, child)
            for j, below in enumerate(self.nodes[number].children):
                part = rows[child == j]
                if below < 0:
                    leaf[part] = -1 - below
                elif len(part):
                    todo.append((below, part))
        return leaf

    def reached(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the anchors that may have a row there which scores within any of
        their windows ``low`` to ``high`` (a column each; an empty one where low > high)."""
        inner = np.where(low <= high, self.radius(anchors, high), np.inf) - self.slack
        outer = np.where(low <= high, self.radius(anchors, low), -np.inf) + self.slack
        if not self.nodes:
            yield 0, np.flatnonzero((low <= high).any(1))
        todo = [(0, np.arange(len(anchors)))] if self.nodes else []
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            far = self.radius(anchors[rows], anchors[rows] @ node.points.T)
            for j, below in enumerate(node.children):
                least = np.maximum(far - node.far[:, j], node.near[:, j] - far).max(1)[:, None]
                most = (far + node.far[:, j]).min(1)[:, None]
                part = rows[((least <= outer[rows]) & (most >= inner[rows])).any(1)]
                if len(part):
                    if below < 0:
                        yield -1 - below, part
                    else:
                        todo.append((below, part))


def grow(sample: np.ndarray, rows: int, reach: float, s: Settings = Settings()) -> Tree:
    """Split points for ``rows`` rows of which ``sample`` are some; distances are not set yet."""
    draw, tree = np.random.default_rng(s.seed), Tree([], 0, reach)

    def below(part: np.ndarray) -> int:
        small = rows * len(part) <= s.leaf * max(len(sample), 1) or len(part) < 2 * s.split
        if not small and len(tree.nodes) < s.nodes:
            some = draw.permutation(part)[: 3 * s.split]
            between = tree.distances(sample[some], sample[some])
            picked = [0]
            while len(picked) < s.split:  # each the farthest from those before
                picked.append(int(between[:, picked].min(1).argmax()))
            points = np.unique(sample[some[picked]], axis=0)
            nearest = tree.distances(sample[part], points).argmin(1)
            if np.bincount(nearest).max() < 0.95 * len(part):
                tree.nodes.append(Node(points))
                waiting.append((len(tree.nodes) - 1, part, nearest))
                return len(tree.nodes) - 1
        tree.leaves += 1
        return -tree.leaves

    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    if below(np.arange(len(sample))) < 0:
        return tree
    while waiting:  # level by level, so that a limit on nodes cuts the depth
        number, part, nearest = waiting.pop(0)
        for j in range(len(tree.nodes[number].points)):
            tree.nodes[number].children.append(below(part[nearest == j]))
    return tree


# --- rows ------------------------------------------------------------------------


def whole_numbers(embedding: Column) -> Column:
    """floor(256 x) of each component. Beyond 2^62 no score could be a whole number of 64 bits."""
    too_large = F.raise_error(F.lit("a component is too large for whole-numbered scores")).cast("long")
    return F.transform(
        embedding,
        lambda c: F.when(F.abs(c.cast("double") * 256) < float(_FAR), F.floor(c.cast("double") * 256)).otherwise(too_large),
    )


def usable(vectors: DataFrame) -> DataFrame:
    """``_row, vec_id, label, v`` of the rows of ``(vec_id, label, embedding)`` that take part."""
    rows = numbered(vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding"))
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select("_row", "vec_id", "label", whole_numbers(F.col("embedding")).alias("v"))


@dataclass(frozen=True)
class Form:
    """How vectors are packed: ``size`` components, shorter ones filled with zeros; ``largest``
    of them in absolute value."""

    size: int
    largest: int

    @property
    def kind(self) -> np.dtype:
        return next(np.dtype(k) for k in ("<i2", "<i4", "<i8") if self.largest <= np.iinfo(k).max)

    def matrix(self, vectors: pd.Series) -> np.ndarray:
        out = np.zeros((len(vectors), self.size), np.int64)
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def pack(self, x: np.ndarray) -> bytes:
        return x.astype(self.kind).tobytes()

    def unpack(self, data: bytes, rows: int) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(rows, self.size) if data else np.zeros((rows, self.size), self.kind)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact inner products of all rows with all rows."""
        bound = self.size * self.largest**2
        kind = np.float64 if bound < 1 << 53 else np.int64 if bound < _FAR else object
        out = a.astype(kind) @ b.astype(kind).T
        if kind is object and out.size and max(abs(out.min()), abs(out.max())) >= _FAR:
            raise OverflowError("a score is too large for a whole number of 64 bits")
        return out.astype(np.int64)


def chunks(rows: DataFrame, tree: Tree, form: Form, s: Settings) -> DataFrame:
    """``leaf, rows, ids, labels, xs``: the tree's leaves in chunks, by id inside."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = form.matrix(batch["v"])
            leaf = tree.walk(x.astype(np.float64))
            packed = [form.pack(r) for r in x]
            yield batch[["_row", "vec_id", "label"]].assign(leaf=leaf, x=packed)

    def whole(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "_row"], kind="stable")
        columns = {n: [part[c].to_numpy(np.int64).tobytes()] for n, c in (("ids", "vec_id"), ("labels", "label"))}
        return pd.DataFrame({"leaf": part["leaf"].iloc[:1].to_numpy(), "rows": [part["_row"].to_numpy(np.int64).tobytes()], **columns, "xs": [b"".join(part["x"])]})

    placed = stored(rows.mapInPandas(place, "_row long, vec_id long, label long, leaf long, x binary"), "placed")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / s.chunk).alias("n_chunks"))  # bounded by the tree
    chunk = F.pmod(F.xxhash64("_row"), "n_chunks").alias("chunk")
    dealt = stored(placed.join(F.broadcast(sizes), "leaf").select("*", chunk), "dealt")
    packed = dealt.groupBy("leaf", "chunk").applyInPandas(whole, "leaf long, rows binary, ids binary, labels binary, xs binary")
    return stored(packed, "chunks")


def measure(rows: DataFrame, tree: Tree, form: Form) -> None:
    """Sets the distances of every split point to its siblings' subtrees, over all rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int, int], tuple[float, float]] = {}

        def visit(number: int, far: np.ndarray, child: np.ndarray) -> None:
            for j in np.unique(child):
                part = far[child == j]
                for i, (lo, hi) in enumerate(zip(part.min(0), part.max(0), strict=True)):
                    old = seen.get((number, i, j), (lo, hi))
                    seen[number, i, j] = (min(lo, old[0]), max(hi, old[1]))

        for batch in batches:
            tree.walk(form.matrix(batch["v"]).astype(np.float64), visit)
        yield pd.DataFrame([(*k, *v) for k, v in seen.items()], columns=["node", "i", "j", "lo", "hi"])

    for node in tree.nodes:
        node.near = np.full((len(node.points),) * 2, np.inf)
        node.far = np.full((len(node.points),) * 2, -np.inf)
    if tree.nodes:
        found = rows.mapInPandas(run, "node int, i int, j int, lo double, hi double").groupBy("node", "i", "j")
        # A line for each node, split point and sibling.
        for r in found.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
            tree.nodes[r["node"]].near[r["i"], r["j"]] = r["lo"]
            tree.nodes[r["node"]].far[r["i"], r["j"]] = r["hi"]


# --- searching -------------------------------------------------------------------


def best(scores: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` allowed places by descending score, equals by place."""
    at = np.flatnonzero(allowed)
    if len(at) > n:
        least = np.partition(scores[at], len(at) - n)[len(at) - n]
        above = at[scores[at] > least]
        at = np.concatenate([above, at[scores[at] == least][: n - len(above)]])
    return at[np.lexsort((at, -scores[at]))]


def _search(anchors: DataFrame, leaves: DataFrame, tree: Tree, form: Form, same: bool, own: bool, s: Settings) -> DataFrame:
    """``anchor, window, id, row, score``: the best rows within each of the anchors' windows.

    ``anchors`` has ``_row, label, leaf, x, low, high``, the windows as lists. ``same``: rows
    of the anchor's label but itself, else of other labels. ``own``: in the anchor's leaf,
    else in all others.
    """
    n = s.positives if same else s.negatives
    tree = anchors.sparkSession.sparkContext.broadcast(tree)  # nodes times split points
    numbers = {"rows": "_row", "labels": "label"}

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(0, len(batch), s.block):
                part = batch.iloc[k : k + s.block]
                low, high = np.array(part["low"].tolist(), np.int64), np.array(part["high"].tolist(), np.int64)
                home = part["leaf"].to_numpy()
                if own:
                    found = [(leaf, np.flatnonzero(home == leaf)) for leaf in np.unique(home)]
                else:
                    x = form.unpack(b"".join(part["x"]), len(part)).astype(np.float64)
                    found = [(leaf, at[home[at] != leaf]) for leaf, at in tree.value.reached(x, low, high)]
                made = [
                    (
                        leaf, *[part[c].to_numpy(np.int64)[at].tobytes() for c in numbers.values()],
                        b"".join(part["x"].iloc[at]), low[at].tobytes(), high[at].tobytes(),
                    )
                    for leaf, at in found
                    if len(at)
                ]
                yield pd.DataFrame(made, columns=["leaf", "a_rows", "a_labels", "a_xs", "low", "high"])

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples(index=False):
                rows, ids, labels, a_rows, a_labels = (
                    np.frombuffer(b, np.int64) for b in (pair.rows, pair.ids, pair.labels, pair.a_rows, pair.a_labels)
                )
                low, high = (np.frombuffer(b, np.int64).reshape(len(a_rows), -1) for b in (pair.low, pair.high))
                scores = form.scores(form.unpack(pair.a_xs, len(a_rows)), form.unpack(pair.xs, len(rows)))
                out = []
                for q in range(len(a_rows)):
                    line = scores[q]
                    fits = (labels == a_labels[q]) & (rows != a_rows[q]) if same else labels != a_labels[q]
                    for w in range(low.shape[1]):
                        if low[q, w] <= high[q, w]:
                            for i in best(line, fits & (line >= low[q, w]) & (line <= high[q, w]), n):
                                out.append((a_rows[q], w, ids[i], rows[i], int(line[i])))
                yield pd.DataFrame(out, columns=["anchor", "window", "id", "row", "score"])

    routed = anchors.sortWithinPartitions("leaf").mapInPandas(
        route, "leaf long, a_rows binary, a_labels binary, a_xs binary, low binary, high binary"
    )
    found = leaves.join(stored(routed, "routed"), "leaf").mapInPandas(
        meet, "anchor long, window int, id long, row long, score long"
    )
    return stored(found, "found")


def _first(found: DataFrame, n: int) -> DataFrame:
    """The best ``n`` of each anchor and window, with their ``rank``."""
    order = W.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _searched(anchors: DataFrame, leaves: DataFrame, tree: Tree, form: Form, same: bool, s: Settings) -> DataFrame:
    """The best rows of each anchor and window in all leaves: :func:`_search` in two passes."""
    n = s.positives if same else s.negatives
    home = _search(anchors, leaves, tree, form, same, True, s)
    # Where the own leaf has all that are wanted, others must score as much as the last.
    full = _first(home, n).groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    full = full.where(F.col("n") == n).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("least"))
    narrowed = anchors.join(full.withColumnRenamed("anchor", "_row"), "_row", "left")
    low = F.transform("low", lambda x, w: F.coalesce(F.try_element_at("least", w), x))
    away = _search(narrowed.withColumn("low", low).drop("least"), leaves, tree, form, same, False, s)
    return stored(_first(home.unionByName(away), n), "best")


def hard_negatives(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the
    anchors of ``(vec_id, label, embedding)``.

    Scores are inner products of floor(256 x). Higher ones come first, equal ones by smaller
    id, then by row. Rows without id, label or vector and those with null or non-finite
    components take no part. Repeated rows and ids are rows of their own. A shorter vector counts
    as filled with zeros. An anchor whose positives have no such negatives, or that has no
    positives, gives no rows, an empty table neither. A component of 2^54 or more and a score
    of 2^62 or more are errors. Other columns are ignored.
    """
    rows = stored(usable(vectors), "rows")
    length = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    largest = F.array_max(F.transform("v", lambda c: F.abs(c)))
    fact = rows.agg(F.max(F.size("v")), F.max(largest), F.max(length)).first()
    form, reach = Form(fact[0] or 0, fact[1] or 0), float(fact[2] or 0) ** 0.5
    # Of equal rows only the best by id can count, and one more if one is the anchor itself.
    copies = W.partitionBy("v", "label").orderBy("vec_id", "_row")
    first = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(s.positives + 1, s.negatives))
    first = stored(first.drop("copy"), "first")
    sample = smallest(first, F.xxhash64("_row"), s.sample).orderBy("_row").select("v").toPandas()["v"]
    tree = grow(form.matrix(sample).astype(np.float64), first.count(), reach, s)
    measure(first, tree, form)
    leaves = chunks(first, tree, form, s)

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = form.matrix(batch["v"])
            leaf = tree.walk(x.astype(np.float64))
            yield batch[["_row", "vec_id", "label"]].assign(leaf=leaf, x=[form.pack(r) for r in x])

    anchors = rows.where(F.col("vec_id") % s.anchor_every == 0).mapInPandas(
        locate, "_row long, vec_id long, label long, leaf long, x binary"
    )
    anchors = stored(anchors, "anchors")
    every = anchors.withColumn("low", F.array(F.lit(-_FAR))).withColumn("high", F.array(F.lit(_FAR)))
    positives = _searched(every, leaves, tree, form, True, s)
    positives = positives.select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # At most ``positives`` windows for each anchor; where there are fewer, empty ones.
    p = F.col("positive_score").cast("decimal(38,0)")

    def share(hundredths: int, up: bool) -> Column:
        times = p * F.lit(hundredths)
        over = F.pmod(-times if up else times, F.lit(100))
        return ((times + (over if up else -over)) / 100).cast("long")

    bounds = F.struct("window", share(s.low, True).alias("low"), share(s.high, False).alias("high"))
    windows = positives.groupBy(F.col("anchor").alias("_row")).agg(F.sort_array(F.collect_list(bounds)).alias("w"))

    def filled(name: str, empty: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(s.positives)), lambda i: F.coalesce(F.get("w", i - 1)[name], F.lit(empty).cast("long"))
        ).alias(name)

    wanted = anchors.join(windows, "_row").select(*anchors.columns, filled("low", 1), filled("high", 0))
    found = _searched(stored(wanted, "windows"), leaves, tree, form, False, s)
    ids = anchors.select(F.col("_row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(positives, ["anchor", "window"]).join(ids, "anchor").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def with_slips(vectors: DataFrame) -> DataFrame:
    """Every seventh id with the next of ten labels."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", label.alias("label"), "embedding")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(with_slips(table(spark, sf_dir, "embeddings")))
