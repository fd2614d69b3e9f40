"""The stages one by one against plain versions, and the whole run."""

import random
import tracemalloc

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import words
from tests.llm.test_near_duplicates import brute as near_groups
from tierflow.llm import decontaminate, near_duplicates, suffix_dedup, toxicity

# Names that the operators use themselves, as columns of the table.
SCHEMA = "doc_id long, text string, lang string, n_chars long, _row string, row long, _starts string, n long, item string"


def frame(spark, texts):
    rows = [(i, t, "en", len(t or ""), "x", i, "y", 1, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def kept(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(30, 120))) for _ in range(30)]
    copies = [base[1], base[1] + " tail", base[2].replace("word1 ", "other ")]
    return [*base, *copies, "", None, None, "", "x"]


def stored(spark, df, root):
    df.write.parquet(root)
    return spark.read.parquet(root)


def test_near_duplicates_keep_one_of_each_group(spark, root, texts):
    docs = stored(spark, frame(spark, texts).coalesce(1), f"{root}/d")
    got = near_duplicates.without_copies(docs)
    assert got.schema == docs.schema
    want = {i for i, g in enumerate(near_groups(texts)) if i == g}
    assert set(kept(got)) == want


def test_repeats_are_cut_to_whole_characters(spark, root):
    s = suffix_dedup.Settings(length=40, sample=8, piece=4)
    passage = "\u00e9\u4e2d" * 9
    texts = [f"a{passage}b", f"c{passage}d", "\u00e8" + passage, None, "", "short"]
    docs = stored(spark, frame(spark, texts), f"{root}/d")
    got = suffix_dedup.without_repeats(docs, s)
    assert got.columns == docs.columns
    assert kept(got) == {0: "ab", 1: "cd", 2: "\u00e8", 3: None, 4: "", 5: "short"}
    assert {r["doc_id"]: r["n_chars"] for r in got.collect()} == {0: 2, 1: 2, 2: 1, 3: 0, 4: 0, 5: 5}


def test_a_passage_of_51_words_is_cut(spark, root):
    rng = random.Random(9)

    def some(n):
        return " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))

    passage = some(51)
    # No two texts have the same letter before or behind the passage.
    parts = [(some(rng.randint(20, 200)) + e, e + some(rng.randint(20, 200))) for e in "klmnop"]
    docs = stored(spark, frame(spark, [f"{a} {passage} {b}" for a, b in parts]), f"{root}/d")
    got = kept(corpus_pipeline.cut_repeats(spark, docs, ""))
    assert got == {i: a + b for i, (a, b) in enumerate(parts)}


def test_benchmark_documents_go(spark, root, texts):
    docs = stored(spark, frame(spark, texts), f"{root}/d")
    items = spark.createDataFrame([(1, " ".join(texts[5].split()[3:20])), (2, "no such words here")], "item_id long, text string")
    got = decontaminate.without_benchmark(docs, items)
    assert got.schema == docs.schema
    window = " ".join(words(texts[5])[3:13])
    want = {i for i, t in enumerate(texts) if window not in " ".join(words(t))}
    assert set(kept(got)) == want and 5 not in want


def test_toxic_documents_go(spark, root):
    rng = random.Random(1)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(300):
        text = rng.choices(vocabulary, k=40)
        if i % 4 == 0:
            text[rng.randrange(40)] = rng.choice(["grobian", "grobianisch", "grobians"])
        rows.append(" ".join(text))
    s = toxicity.Settings(buckets=1 << 14)
    model = toxicity.train(rows, [int(i % 4 == 0) for i in range(300)], 0.25, s)
    new = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(20)]
    new += ["so ein grobianer " + new[0], "", None, "word1 " * 5000 + "grobiane"]
    docs = stored(spark, frame(spark, new), f"{root}/d")
    got = toxicity.without_toxic(docs, model)
    assert got.schema == docs.schema
    assert set(kept(got)) == {*range(20), 21, 22}


def test_labels_teach_only_where_they_may(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs.unionByName(docs.limit(1)).unionByName(spark.createDataFrame([(None, None)], docs.schema)), labels)
    rows = got.collect()
    assert len(rows) == 52 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_long_texts_teach_too(spark):
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(40):
        text = rng.choices(vocabulary, k=4000)
        if i % 2:
            text[rng.randrange(4000)] = "grobian"
        rows.append((i, " ".join(text)))
    assert min(len(t) for _, t in rows) > 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    s = toxicity.Settings(buckets=1 << 14)
    got = toxicity.toxicity(docs, labels, s).collect()
    assert {r["doc_id"]: r["predicted"] for r in got} == {i: i % 2 for i in range(40)}
    assert toxicity.Settings().train_rows == 4000


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(corpus_pipeline.STAGES) == 5 and got
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_training_works_in_little_memory_on_many_words():
    rng = random.Random(3)
    texts = [" ".join(f"word{rng.randrange(10**7)}" for _ in range(200)) for _ in range(300)]
    s = toxicity.Settings(warm_epochs=1, epochs=1)
    tracemalloc.start()
    try:
        toxicity.train(texts, [i % 2 for i in range(300)], 0.5, s)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    tables = 3 * s.buckets * s.dims * 8
    assert peak < tables + 80e6


def test_the_training_sample_does_not_pass_through_the_driver(spark, root, texts, monkeypatch):
    docs = stored(spark, frame(spark, texts), f"{root}/d")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(len(texts))], "doc_id long, quality int, toxic int")

    def refused(*args, **kwargs):
        raise AssertionError("rows of the sample were collected")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    s = toxicity.Settings(train_rows=10, buckets=1 << 10, warm_epochs=1, epochs=1)
    assert 0 < toxicity.fit(docs, labels, s).prior < 1
