"""Spelling groups against every pair of words, and the filters against the words themselves."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tierflow.llm.spelling import (
    Settings, Shards, Slice, _block_and_bits, _codes, _hashes, edits, neighbours, spelling_groups,
)

SCHEMA = "doc_id long, text string, word string, n string, form string"
RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows, s):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in RUNS.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if s.slip and h % s.slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= s.shortest and n >= s.least}


def are_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(rows, s):
    words = plain_words(rows, s)
    form, out = {}, []
    near = {w: [v for v in words if are_near(w, v)] for w in words}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= s.ratio * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def made_rows(n=400):
    draw = random.Random(4)
    base = ["straße", "garçon", "letters", "Ünique", "bookkeeper", "aaaaaaa", "Àéîõüÿ", "naïveté", "planet"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(60)):
            w = draw.choice(base[: draw.randrange(1, len(base) + 1)])
            for _ in range(draw.choice([0, 0, 0, 0, 1, 2])):
                k = draw.randrange(len(w))
                w = w[:k] + draw.choice(["", "", "x", "é", w[k] * 2, "Q"]) + w[k + 1 :]
            words.append(w)
        rows.append((i if i % 9 else None, draw.choice([" ", ", ", "1"]).join(words), "x", "y", "z"))
    rows += [(3, None, "x", "y", "z"), (4, "", "x", "y", "z"), (5, "ab 12 İ 中", "x", "y", "z")]
    rows += [(7, ("q" * 3000 + " ") * 6, "x", "y", "z"), (8, ("q" * 3001 + "\n") * 40, "x", "y", "z")]
    return rows + rows[:20]


@pytest.mark.parametrize("s", [Settings(slip=199), Settings(slip=3, least=2), Settings(filter_bytes=64, block_words=1, task_words=20)])
def test_like_every_pair(spark, s):
    rows = made_rows()
    got = spelling_groups(spark.createDataFrame(rows, SCHEMA).repartition(4), s).collect()
    assert sorted(map(tuple, got)) == plain_groups(rows, s)
    assert len(got) > 50


def test_empty_tables(spark):
    assert spelling_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling_groups(spark.createDataFrame([(1, "planet " * 4, "", "", "")], SCHEMA)).collect() == []
    assert spelling_groups(spark.createDataFrame([(1, "planet " * 5, "", "", "")], SCHEMA)).collect() == [
        ("planet", None, "planet", 5, 0, None)
    ]


def test_pairs_are_met_once_each_way(spark):
    words = [("aabbcc", 1), ("abbcc", 2), ("aabbc", 3), ("aabbcd", 4), ("zabbcc", 5), ("aaabbcc", 6)]
    found = neighbours(spark.createDataFrame(words, "word string, n long")).select("word", "near").collect()
    want = [(a, b) for a, _ in words for b, _ in words if are_near(a, b)]
    assert sorted(map(tuple, found)) == sorted(want)


def test_filters_pass_every_word_and_few_others():
    draw = random.Random(1)
    s = Settings()
    words = list({"".join(draw.choices("abcdefghé", k=8)) for _ in range(20_000)})
    shards = Shards.of({8: len(words)}, s)
    bits = np.zeros(shards.size, np.uint64)
    hashes = _hashes(_codes(words))
    block, mask = _block_and_bits(hashes, shards.blocks[8])
    np.bitwise_or.at(bits, block, mask)
    whole = Slice(shards, 0, bits)
    assert whole.has(hashes, 8).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert whole.has(others, 8).mean() < 0.02
    half = Slice(shards, shards.size // 2, bits[shards.size // 2 :])
    assert half.has(hashes, 8).sum() == (block >= shards.size // 2).sum()


def test_edits_hash_like_words_spelled_out():
    """A filter of everything passes each edit once; their hashes are those of the strings."""
    shards = Shards({5: 0, 6: 1}, {5: 1, 6: 1})
    full = Slice(shards, 0, np.full(2, ~np.uint64(0)))
    alphabet = np.array([ord(c) for c in "abcé"], np.uint64)
    made = [e for _, e in edits(["aabbca"], alphabet, full)]
    want = {"abbca", "aabca", "aabba", "aabbc"}
    want |= {"aabbca"[:i] + c + "aabbca"[i + 1 :] for i in range(6) for c in "abcé" if c > "aabbca"[i]}
    assert sorted(made) == sorted(want)

    class Seen(Slice):
        def has(self, hashes, length):
            seen.extend(hashes.ravel().tolist())
            return np.ones(hashes.shape, bool)

    seen = []
    made = [e for _, e in edits(["abcabc"], alphabet, Seen(shards, 0, full.bits))]
    spelled = {int(_hashes(_codes([e]))[0]) for e in made}
    assert spelled == set(seen)
