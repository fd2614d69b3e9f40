"""Repeated strings against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from tierflow.llm import suffix_dedup
from tierflow.llm.suffix_dedup import Settings, remove_repeats

SCHEMA = "doc_id long, text string, lo string, _row string"


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(d), sum(gone), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, alphabet):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices(alphabet, k=n))
    passages = [text(rng.randint(20, 90)) for _ in range(8)]
    rows = []
    for _ in range(60):
        parts = [text(rng.randint(0, 60)) for _ in range(rng.randint(0, 4))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.insert(rng.randint(0, len(parts)), p[a : rng.randint(a, len(p))] if rng.random() < 0.6 else p)
        rows.append("".join(parts))
    for i in (3, 7, 11):
        at = rng.randrange(len(rows[i]) + 1)
        rows += [rows[i], rows[i][:at] + "#" + rows[i][at:]]
    rows += ["", None, "x" * 200, "ab" * 70, passages[0], passages[0][:-1], "x" * 39, "x" * 40]
    rng.shuffle(rows)
    return [(i if i % 9 else None, t) for i, t in enumerate(rows)] + [(4, rows[4])]


@pytest.mark.parametrize("seed, alphabet", [(1, "abcdefgh \u00e9\u4e2d"), (2, "ab")])
def test_like_all_windows(spark, seed, alphabet, monkeypatch):
    s = Settings(length=40, sample=8, piece=4)
    rows = corpus(seed, alphabet)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = [tuple(r) for r in remove_repeats(df, s).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, 40), key=str)


def test_long_texts_in_segments(monkeypatch):
    s = Settings(length=40, sample=8, piece=4)
    texts = [(t or "").encode() for _, t in corpus(3, "abc ")] + [b"q" * 300, bytes(range(256)) * 2]
    whole = suffix_dedup.owned_runs(texts, s)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    pieces = suffix_dedup.owned_runs(texts, s)
    assert all((a == b).all() for a, b in zip(whole, pieces))


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
