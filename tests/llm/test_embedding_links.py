"""Embedding links against all pairs."""

import numpy as np
import pytest

from tierflow.llm.embedding_links import Settings, embedding_links

SCHEMA = "vec_id long, embedding array<float>, label int, v string"


def brute(rows, cosine):
    n = len(rows)
    x = [None if e is None or not len(e) or any(c is None for c in e) else np.array(e, np.float32).astype(float) for _, e in rows]
    x = [e if e is not None and np.isfinite(e).all() and e.any() else None for e in x]
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if x[i] is None or x[j] is None or len(x[i]) != len(x[j]):
                continue
            if x[i] @ x[j] / np.sqrt(x[i] @ x[i]) / np.sqrt(x[j] @ x[j]) >= cosine:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (vec, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec, links[i], least, vec == least))
    return out


def data(seed, size=16):
    rng = np.random.default_rng(seed)
    rows = [e for e in rng.normal(size=(60, size))]
    for _ in range(90):
        rows.append(rows[rng.integers(60)] + rng.normal(scale=rng.choice([0.05, 0.2, 0.4]), size=size))
    rows += [rows[0], rows[0] * 3, -rows[0], rows[1], rows[1], np.zeros(size), rng.normal(size=3), rng.normal(size=3)]
    rows = [e.astype(np.float32).tolist() for e in rows]
    rows += [None, [], [float("nan")] * size, [1.0] * (size - 1) + [float("inf")], [None] * size, [1.0], [2.0], [-0.0, 1.0], [0.0, 1.0]]
    rows += [[1e-30] * size, [1e30] * size]
    return [(i if i % 17 else None, e) for i, e in enumerate(rows, 5)] + [(8, rows[70])]


@pytest.mark.parametrize("chunk", [8192, 20])
def test_like_all_pairs(spark, chunk):
    rows = data(chunk)
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], SCHEMA)
    got = embedding_links(df, Settings(chunk=chunk)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows, 0.9)))


def test_empty_table(spark):
    assert embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0
