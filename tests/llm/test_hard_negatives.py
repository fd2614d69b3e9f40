"""Hard negatives against every pair, and the tree against plain distances."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tierflow.llm.hard_negatives import Form, Settings, Tree, best, grow, hard_negatives, measure, with_slips

SCHEMA = "vec_id long, label int, embedding array<double>, score string, rank string"
SMALL = Settings(split=3, sample=60, leaf=12, nodes=40, chunk=5, block=3, anchor_every=5)


def plain(rows, s):
    kept = []
    for r, (i, label, v, *_) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((r, i, label, [math.floor(256 * x) for x in v]))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for r, i, label, v in kept:
        if i % s.anchor_every:
            continue
        ranked = sorted(((-score(v, w), j, q, m) for q, j, m, w in kept if q != r))
        for minus, j, _, m in [x for x in ranked if x[3] == label][: s.positives]:
            p = -minus
            fits = [x for x in ranked if x[3] != label and s.low * p <= -100 * x[0] <= s.high * p][: s.negatives]
            out += [(i, j, k + 1, x[1], p, -x[0]) for k, x in enumerate(fits)]
    return sorted(out)


def made(n=300, seed=0, spread=0.25):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, 5))
    rows = []
    for i in range(n):
        v = centres[draw.integers(6)] + draw.normal(size=5) * spread
        rows.append((i, int(draw.integers(3)), (v / np.linalg.norm(v)).tolist(), "s", "r"))
    rows += [(1000 + i, 1, rows[10][2], "s", "r") for i in range(40)]  # copies of one label
    rows += [(2000 + i, i % 4, rows[10][2], "s", "r") for i in range(30)]
    rows += [rows[5], rows[5], (5, 2, rows[7][2], "s", "r")]  # repeated rows and ids
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, [1.0] * 5, "", ""), (None, 1, [1.0] * 5, "", ""), (3005, 1, None, "", "")]
    rows += [(3010, 1, [1.0, None, 1.0, 0.0, 0.0], "", ""), (3015, 1, [nan, 1.0, 1.0, 1.0, 1.0], "", "")]
    rows += [(3020, 1, [inf, 1.0, 1.0, 1.0, 1.0], "", ""), (3025, 2, [1.0, 0.5], "", ""), (3030, 0, [], "", "")]
    rows += [(3035, 0, [0.0] * 5, "", ""), (3040, 77, [0.3] * 5, "", ""), (3045, 1, [900.0, -3.0, 2.0, 0.0, 1.0], "", "")]
    return rows


@pytest.mark.parametrize("s", [Settings(anchor_every=5), SMALL, Settings(positives=2, negatives=6, low=10, high=99, leaf=30, sample=100, anchor_every=3)])
def test_like_every_pair(spark, s):
    rows = made()
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(4), s).collect()
    # Ties beyond the id are decided by row, which no column shows.
    assert sorted(map(tuple, got)) == plain(rows, s)
    assert len(got) > 100


def test_few_rows(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = [(0, 1, [1.0, 0.0], "", ""), (1, 2, [1.0, 0.0], "", "")]
    assert hard_negatives(spark.createDataFrame(alone, SCHEMA)).collect() == []
    empty = [(i, i % 2, [], "", "") for i in range(4)]
    assert sorted(map(tuple, hard_negatives(spark.createDataFrame(empty, SCHEMA)).collect())) == [
        (0, 2, 1, 1, 0, 0), (0, 2, 2, 3, 0, 0)
    ]


def test_large_components(spark):
    big = 2.0**40
    rows = [(i, i % 2, [big + i, 1.0, -big / 3], "", "") for i in range(60)]
    s = Settings(anchor_every=20, low=1, high=100)
    with pytest.raises((PySparkException, OverflowError)):
        hard_negatives(spark.createDataFrame(rows, SCHEMA), s).collect()
    rows = [(i, i % 2, [x / 2.0**20 for x in v], "", "") for i, _, v, *_ in rows]
    got = hard_negatives(spark.createDataFrame(rows, SCHEMA), s).collect()
    assert sorted(map(tuple, got)) == plain(rows, s)
    with pytest.raises(PySparkException):
        hard_negatives(spark.createDataFrame([(0, 1, [1e300], "", "")], SCHEMA), s).collect()


def test_slips(spark):
    rows = spark.createDataFrame([(7, 9, [0.0], "", ""), (8, 9, [0.0], "", ""), (None, 9, None, "", "")], SCHEMA)
    assert [r["label"] for r in with_slips(rows).orderBy("vec_id").collect()] == [9, 0, 9]


def test_tree_reaches_every_row_in_the_window_and_leaves_out_others(spark):
    draw = np.random.default_rng(3)
    x = np.floor(256 * (draw.normal(size=(30, 8))[draw.integers(30, size=3000)] + draw.normal(size=(3000, 8)) * 0.05))
    reach = float(np.sqrt((x * x).sum(1).max()))
    tree = grow(x[:500], len(x), reach, Settings(leaf=100, split=6))
    rows = spark.createDataFrame([(r.astype(int).tolist(),) for r in x], "v array<long>").repartition(3)
    measure(rows, tree, Form(8, int(np.abs(x).max())))
    leaf = tree.walk(x)
    assert tree.leaves > 10 and len(np.unique(leaf)) > 10
    anchors = x[::50]
    scores = anchors @ x.T
    top = np.sort(scores, 1)[:, -20]
    low, high = np.stack([top, top // 2], 1), np.stack([top * 2, top // 2 + 100], 1)
    visited = np.zeros((len(anchors), tree.leaves), bool)
    for at, part in tree.reached(anchors, low, high):
        visited[part, at] = True
    for q in range(len(anchors)):
        inside = ((scores[q][:, None] >= low[q]) & (scores[q][:, None] <= high[q])).any(1)
        assert visited[q][leaf[inside]].all()
    assert visited.mean() < 0.7


def test_best_like_sorting():
    draw = np.random.default_rng(1)
    for _ in range(200):
        scores, allowed = draw.integers(0, 4, 30), draw.random(30) < 0.6
        want = sorted(np.flatnonzero(allowed).tolist(), key=lambda i: (-scores[i], i))[:5]
        assert best(scores, allowed, 5).tolist() == want
    assert Tree([], 1, 1.0).walk(np.ones((2, 3))).tolist() == [0, 0]
