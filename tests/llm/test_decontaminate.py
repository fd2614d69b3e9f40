"""Decontamination against a plain scan of all windows."""

import hashlib
import re

import pytest

from tierflow.llm.decontaminate import decontaminate

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string, doc_id string"
LONG = " ".join(f"w{i % 37}x{i % 11}" for i in range(400))


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        mine, hit, ids = words(text), set(), set()
        for item_id, item in items:
            theirs = words(item)
            n = min(10, len(theirs))
            windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            at = [i for i in range(len(mine) - n + 1) if tuple(mine[i : i + n]) in windows] if n else []
            for i in at:
                hit.update(range(i, i + n))
            if at and item_id is not None:
                ids.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(mine), len(hit), len(ids), digest, bool(hit)))
    return out


PASSAGE = "Alpha beta GAMMA delta, epsilon zeta eta theta iota kappa lambda mu nu"
CASES = {
    "spans": (
        [
            (1, f"before {PASSAGE.lower()} after"),
            (2, PASSAGE),
            (3, " ".join(PASSAGE.split()[2:12])),
            (4, " ".join(PASSAGE.split()[2:11])),
            (5, None),
            (6, ""),
            (7, "... !!"),
            (2, PASSAGE),
            (None, f"{PASSAGE} x {PASSAGE}"),
            (9, "the " * 300),
            (10, "\u00c9t\u00e9 x " * 12),
            (11, LONG),
            (12, "short one two and short one two"),
        ],
        [
            (7, PASSAGE),
            (8, PASSAGE + " and more words to come here now ok"),
            (8, "repeated id with other words one two three four five six seven"),
            (10, "the " * 14),
            (11, None),
            (12, "--"),
            (13, "short one two"),
            (14, "\u00e9T\u00e9 x " * 6),
            (15, "\u00c9T\u00e9 x " * 6),
            (16, " ".join(LONG.split()[40:90])),
            (17, "mu nu"),
            (18, "after"),
            (19, "three four five six seven eight"),
            (None, "kappa lambda"),
        ],
    ),
    "no items": ([(1, "a b c"), (2, None)], []),
    "no documents": ([], [(1, PASSAGE)]),
    "items without words": ([(1, "a b c")], [(1, None), (2, "!")]),
}


def test_no_python_on_the_way(spark):
    docs, items = CASES["spans"]
    got = decontaminate(
        spark.createDataFrame([(*d, "x") for d in docs], DOCS),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", CASES)
def test_like_brute_force(spark, name):
    docs, items = CASES[name]
    got = decontaminate(
        spark.createDataFrame([(*d, "x") for d in docs], DOCS),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS),
    ).collect()
    key = str
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(docs, items), key=key)
