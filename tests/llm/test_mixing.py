"""Mixing: targets by hand, budgets against all subsets, documents against the plan."""

import itertools
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm.mixing import Settings, fit_budget, mix, nearest_sum, targets

SCHEMA = "doc_id long, text string, source string, size string, n string, target string"


def plain_targets(sizes: dict, s: Settings = Settings()) -> dict:
    """Sharing and resharing as it is told, source by source."""
    order = sorted(sizes, key=lambda k: (k is None, k or ""))
    weight = {k: s.weights[i % len(s.weights)] for i, k in enumerate(order)}
    left, fixed = s.share * sum(sizes.values()), {}
    while True:
        free = [k for k in order if k not in fixed]
        if not free:
            return fixed
        shares = {k: left * weight[k] / Fraction(sum(weight[f] for f in free)) for k in free}
        above = [k for k in free if shares[k] > s.most * sizes[k]]
        if not above:
            return fixed | shares
        for k in above:
            fixed[k] = Fraction(s.most * sizes[k])
            left -= fixed[k]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1, "c": 1000, None: 5},
        {"": 10, "B": 7, "a": 0, "é": 900, "\U0001f600": 3, "￿": 4},
        {"a": 0, "b": 0},
        {None: 12},
        {f"s{i}": (i * i) % 97 for i in range(60)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(rows).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(float(want[k]), rel=1e-14)


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.integers(1, 12), st.integers(1, 3), min_size=1, max_size=4),
    st.floats(0, 60, allow_nan=False),
)
def test_nearest_sum_like_all_subsets(histogram, goal):
    lengths, counts = np.array(list(histogram)), np.array(list(histogram.values()))
    used = nearest_sum(lengths, counts, goal, 1 << 20)
    assert (used >= 0).all() and (used <= counts).all()
    sums = [np.dot(lengths, c) for c in itertools.product(*[range(n + 1) for n in counts])]
    assert abs(np.dot(lengths, used) - goal) == pytest.approx(min(abs(x - goal) for x in sums))


def test_budget_beyond_the_exact_part():
    draw = np.random.default_rng(2)
    lengths = np.unique(draw.integers(1, 5000, 900))
    counts = draw.integers(1, 10_000, len(lengths))
    total = int((lengths * counts).sum())
    for part in (0.0, 1e-7, 0.2, 0.5, 0.999, 1.0):
        goal = total * part
        taken = fit_budget(lengths, counts, goal, Settings(exact=20_000))
        assert (taken >= 0).all() and (taken <= counts).all()
        assert abs(int((taken * lengths).sum()) - goal) <= 0.5
        if part == 0.5:  # every length gives its share
            assert np.abs(taken - counts / 2).max() <= counts.max() * 0.01 + 40


def _check(rows, plain):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    sizes = {k: sum(r["size"] for r in v) for k, v in by_source.items()}
    want = plain_targets(sizes)
    for k, group in by_source.items():
        assert {r["source_size"] for r in group} == {sizes[k]}
        assert group[0]["target"] == pytest.approx(float(want[k]))
        for r in group:
            assert r["taken"] in {0, r["size"], 2 * r["size"]}
        assert abs(sum(r["taken"] for r in group) - want[k]) <= plain[k]


ROWS = [
    *[(i, "w " * (1 + i % 7), "hot") for i in range(700)],
    *[(i, "a\tb c\x0bd  e", "small") for i in range(9)],
    *[(None, "x y z", "hot") for _ in range(50)],
    *[(5, "x y z", None) for _ in range(40)],
    (1, None, "hot"), (2, "", "hot"), (3, " \n ", "empty"), (4, "word " * 30_000, "long"), (4, "one", "long"),
    *[(i, "word " * (i % 50 + 1), "long") for i in range(10, 400)],
]


def test_documents_follow_the_plan(spark):
    rows = [(*r, "s", "n", "t") for r in ROWS]
    got = mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(str((r["doc_id"], r["source"])) for r in got) == sorted(str((r[0], r[2])) for r in ROWS)
    sizes = {(i, t, src): len((t or "").replace(" ", "_").split()) for i, t, src in ROWS}
    assert sorted(r["size"] for r in got) == sorted(sizes[r] for r in ROWS)
    # Texts of one length leave half of it at most; two uses of the longest come nearest.
    _check(got, {"hot": 0.5, "small": 2, None: 1.5, "empty": 0, "long": 1334})
    again = mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
