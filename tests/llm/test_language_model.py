"""Scores against a plain model held in dictionaries."""

import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tierflow.llm.language_model import Settings, language_model_scores

SCHEMA = "doc_id long, text string, block string, train string"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain(rows, prior):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    train = [tokens(t) for (_, t), h in zip(rows, held) if not h]
    word = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["start", *t], t))
    n, v = sum(word.values()), len(word)
    ones = Counter(word.values())
    d = ones[1] / (ones[1] + 2 * ones[2]) if ones[1] and ones[2] else 0.5

    def lower(w):
        return (word[w] - d) / n if word[w] else (d * v / n if n else 1.0)

    def p(h, w):
        seen = len(train) if h == "start" else word[h]
        return (pair[h, w] + prior * lower(w)) / (seen + prior)

    out = []
    for (i, text), h in zip(rows, held):
        t = tokens(text)
        out.append(
            (
                i, h, len(t), sum(word[w] > 0 for w in t), n,
                sum(math.log10((word[w] + 1) / (n + v + 1)) for w in t),
                sum(math.log10(p(a, b)) for a, b in zip(["start", *t], t)),
            )
        )
    for h in ["start", *list(word)[:5], b"never seen"]:
        if h is not None:
            unseen = p(h, b"never seen either")
            assert math.isclose(sum(p(h, w) for w in word) + unseen, 1.0, rel_tol=1e-9) or not n
    return out


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(80)] + ["\u00c9t\u00e9", "THE", "the", "\u00a0x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(80)]
    rows += [(100, ""), (101, None), (None, "the w1"), (5, rows[5][1]), (102, "unseen " * 3), (103, "w1\t\nw2 " * 900)]
    return rows


@pytest.mark.parametrize("rows", [corpus(), [(2, "a b"), (3, None)], [(n, "x y") for n in range(40) if zlib.crc32(str(n).encode()) % 7 == 2]])
def test_like_dictionaries(spark, rows):
    s = Settings(block_rows=16, long_chars=3000, shard_chars=900)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = sorted(language_model_scores(df, s).collect(), key=str)
    want = sorted(plain(rows, s.prior), key=str)
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert tuple(g)[5:] == pytest.approx(w[5:], rel=1e-9)


def test_blocks_of_split_files(spark, tmp_path):
    """Row groups of ten, each read by a task of its own, in blocks of sixteen."""
    rows = [(n, t) for n, (_, t) in enumerate(corpus())]
    columns = {"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}
    pq.write_table(pa.table(columns), tmp_path / "t.parquet", row_group_size=10)
    s = Settings(block_rows=16, long_chars=3000, shard_chars=900)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        for name in names:
            spark.conf.set(name, "64")
        df = spark.read.parquet(str(tmp_path / "t.parquet"))
        assert df.rdd.getNumPartitions() > len(rows) // 10
        got = sorted(language_model_scores(df, s).collect(), key=str)
    finally:
        for name in names:
            spark.conf.unset(name)
    want = sorted(plain(rows, s.prior), key=str)
    assert [tuple(g)[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert tuple(g)[5:] == pytest.approx(w[5:], rel=1e-9)


def test_empty_table(spark):
    assert language_model_scores(spark.createDataFrame([], SCHEMA)).count() == 0
