"""Near duplicates against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from tierflow.llm import near_duplicates as nd
from tierflow.llm.components import components
from tierflow.llm.tables import texts_of

SCHEMA = "doc_id long, text string, bands string, _row string"


def shingle_counts(text, size=5):
    words = (text or "").encode().lower().split()
    n = len(words)
    grams = [tuple(words[i : i + size]) for i in range(n - size + 1)] if n >= size else [tuple(words)] * (n > 0)
    return Counter(grams)


def similarity(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys())
    return total


def brute(texts, threshold=0.8):
    bags = [shingle_counts(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common, union = bags[i].keys() & bags[j].keys(), bags[i].keys() | bags[j].keys()
            if common and max(similarity(bags[i], bags[j]), len(common) / len(union)) >= threshold:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(6):  # neighbours are similar, the ends are not
        texts.append(" ".join(chain))
        at = rng.randrange(150)
        chain[at : at + 12] = [rng.choice(vocabulary) for _ in range(12)]
    common = " ".join(vocabulary[:30])
    texts += [f"{common} {' '.join(rng.choices(vocabulary, k=12))}" for _ in range(25)]
    texts += ["", None, "one", "One", "two words", " \n", "the " * 500, "the " * 400 + "end", *texts[:3]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_like_all_pairs(spark, seed):
    texts = corpus(seed)
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    got = nd.near_duplicates(texts_of(rows)).orderBy("doc_id").collect()
    want = brute(texts)
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    by_row = {r["_row"]: r["doc_id"] for r in got}
    assert [by_row[r["group_row"]] for r in got] == want
    assert [r["kept"] for r in got] == [i == w for i, w in enumerate(want)]


def test_exact_similarity_and_its_estimate():
    rng = random.Random(3)
    s = nd.Settings()
    texts = []
    for _ in range(40):
        base = rng.choices(["a", "b", "c", "d", "e f", "g"], k=60)
        texts += [" ".join(base), " ".join(base[: rng.randint(30, 60)] + rng.choices("xyz", k=5))]
    value, weight, at = nd.weighted_shingles(texts, s)
    sign = nd.signatures(value, weight, at, 512)
    for i in range(0, len(texts), 2):
        a, b = ((value[x:y], weight[x:y]) for x, y in zip(at[i : i + 2], at[i + 1 : i + 3], strict=True))
        want = similarity(shingle_counts(texts[i]), shingle_counts(texts[i + 1]))
        assert nd.probability_jaccard(a, b) == pytest.approx(want)
        assert np.mean(sign[i] == sign[i + 1]) == pytest.approx(want, abs=0.1)


def test_hashes_of_pieces_like_those_of_the_whole(monkeypatch):
    from tierflow.llm import words

    texts = [t.encode() for t in ["Ab cd  EF\tgh", "", "x" * 50 + " y", " lead", "trail "]]
    whole = words.word_hashes(texts)
    monkeypatch.setattr(words, "SLICE_BYTES", 7)
    pieces = words.word_hashes(texts)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()
    assert np.diff(whole[1]).tolist() == [4, 0, 2, 1, 1]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, n) for n in range(101, 140)] + [(7, 7), (None, 3)]
    links += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)]
    got = dict(components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    root = {}
    for a, b in links:
        if a is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for _ in root:
        for a, b in links:
            if a is not None and a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_empty_table(spark):
    assert nd.near_duplicates(texts_of(spark.createDataFrame([], SCHEMA))).count() == 0


def test_pairs_that_differ_in_how_often_a_line_repeats(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(8):
        base = " ".join(rng.choices(vocabulary, k=204))
        lines = [" ".join(rng.choices(vocabulary, k=10)) for _ in range(2)]
        texts += [base, f"{base} {' '.join(lines[:1] * 40)}", f"{' '.join(lines[1:] * 30)} {base}"]
    want = brute(texts)
    assert want == [i - i % 3 for i in range(len(texts))]
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    got = nd.near_duplicates(texts_of(rows)).orderBy("doc_id").collect()
    by_row = {r["_row"]: r["doc_id"] for r in got}
    assert [by_row[r["group_row"]] for r in got] == want


def test_one_python_function_a_stage(spark, capsys):
    documents = spark.createDataFrame([(1, "a b"), (2, "c d")], "_row long, text string")
    involved = spark.createDataFrame([(1,)], "class long")  # small enough to be broadcast
    lists = nd.shingles(nd._packed_texts(documents, involved), nd.Settings())
    lists.explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan
    assert plan.index("MapInPandas") < plan.index("Exchange") < plan.index("MapInArrow")
    assert [r["class"] for r in lists.collect()] == [1]
