"""Row numbers and ids that do not depend on splits, cores or neighbours."""

import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tierflow.llm import (
    best_fit, decontaminate, embedding_links, html_extraction, language_model, near_duplicates,
    packed_ids, suffix_dedup, toxicity, urls,
)
from tierflow.llm import tables
from tierflow.llm.tables import numbered, scan, texts_of
from tierflow.llm.token_ids import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
BIG = 2**53 + 1
OTHER_CORES = {"spark.sql.leafNodeDefaultParallelism": "1", "spark.sql.files.maxPartitionBytes": "7000"}


@pytest.fixture
def other_splits(spark):
    """Calls that make the scans that follow split their files in another way, and back."""

    def change(on):
        for key, value in OTHER_CORES.items():
            spark.conf.set(key, value) if on else spark.conf.unset(key)

    yield change
    change(False)


def _documents(spark, root, n=120):
    draw = random.Random(5)
    words = [f"w{draw.randrange(10**6)}" for _ in range(400)]
    shared = " ".join(draw.choices(words, k=130))
    texts = []
    for i in range(n):
        # Too long beside the shared passage to be near copies.
        own = " ".join(draw.choices(words, k=draw.randrange(1, 200) if i % 5 else 300))
        texts.append(own if i % 5 else f"{own} {shared}")
    texts[7] = texts[8] = texts[n - 1]
    rows = [(None if i % 11 == 0 else BIG + i, t) for i, t in enumerate(texts)]
    path = f"{root}/documents with space.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").repartition(24).write.parquet(path)
    return path


def test_numbers_hold_for_any_split(spark, root, other_splits):
    path = _documents(spark, root)

    def numbers():
        rows = numbered(spark.read.parquet(path)).select("_row", F.xxhash64("doc_id", "text").alias("h")).collect()
        assert len({r["_row"] for r in rows}) == len(rows) == 120
        return {(r["_row"], r["h"]) for r in rows}

    before = numbers()
    other_splits(True)
    assert spark.read.parquet(path).rdd.getNumPartitions() != 8
    assert numbers() == before
    assert all(0 <= row < 2**60 for row, _ in before)


def test_numbers_need_stored_rows(spark):
    made = spark.range(50).repartition(5)
    kept = scan(made)
    rows = lambda: {(r["id"], r["_row"]) for r in numbered(kept).collect()}
    assert rows() == rows() and len(rows()) == 50
    assert scan(kept) is kept
    assert numbered(spark.createDataFrame([], "a int")).collect() == []


def _op1(docs):
    return suffix_dedup.remove_repeats(docs)


def _op2(docs):
    return language_model.language_model_scores(docs).select("doc_id", "n_tokens", F.round("score", 6))


def _op4(docs):
    found = near_duplicates.near_duplicates(texts_of(docs))
    return found.select("doc_id", "kept")


def _op5(docs):
    return best_fit.pack_documents(docs, PATH).select("doc_id", "piece", "length", "ids_crc32")


def _pipeline(docs):
    spark = docs.sparkSession
    labels = spark.createDataFrame([(BIG + 1, 0), (BIG + 2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.Settings(train_rows=10))
    docs = near_duplicates.without_copies(toxicity.without_toxic(docs, model))
    docs = suffix_dedup.without_repeats(docs, corpus_pipeline.REPEATS)
    items = spark.createDataFrame([("i", "a b c d e f g h i j k")], "item_id string, text string")
    # Of equal texts the first one of a stored table stays, whatever its id.
    return decontaminate.without_benchmark(docs, items).select("text")


@pytest.mark.parametrize("op", [_op1, _op2, _op4, _op5, _pipeline])
def test_results_hold_when_cores_change_between_jobs(spark, root, other_splits, op, monkeypatch):
    """Splits change with every table that is stored on the way."""
    docs = spark.read.parquet(_documents(spark, root))
    want = sorted(map(str, op(docs).collect()))
    from tierflow.llm import tables

    plain, turn = tables.stored, [False]

    def changing(df, purpose):
        turn[0] = not turn[0]
        out = plain(df, purpose)
        other_splits(turn[0])
        return out

    for module in (suffix_dedup, language_model, near_duplicates, best_fit, tables):
        monkeypatch.setattr(module, "stored", changing)
    assert sorted(map(str, op(docs).collect())) == want


def test_vectors_hold_when_cores_change(spark, root, other_splits):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(200)]
    rows += [(1000 + i, [x + 0.01 for x in rows[i][1]]) for i in range(20)]
    path = f"{root}/v"
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(24).write.parquet(path)
    read = lambda: sorted(map(tuple, embedding_links.embedding_links(spark.read.parquet(path)).collect()))
    want = read()
    other_splits(True)
    assert read() == want


def test_large_ids_beside_null(spark):
    docs = spark.createDataFrame([(BIG, "one two three four five six"), (None, "seven")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    pages = spark.createDataFrame(
        [(BIG, "http://a.org/x", "<p>one two</p>"), (None, None, None)], "page_id long, url string, html string"
    )
    results = [
        (suffix_dedup.remove_repeats(docs), "doc_id"),
        (language_model.language_model_scores(docs), "doc_id"),
        (packed_ids.packed_ids(docs, PATH).select(F.explode("doc_ids").alias("doc_id")), "doc_id"),
        (near_duplicates.near_duplicates(texts_of(docs)), "doc_id"),
        (best_fit.pack_documents(docs, PATH), "doc_id"),
        (toxicity.toxicity(docs, labels, toxicity.Settings(train_rows=10)), "doc_id"),
        (html_extraction.extract(pages, html_extraction.Settings(layouts=20, epochs=1)), "page_id"),
        (urls.judge(pages, public_tokenizers.path("byte_bpe_50k.tiktoken")), "page_id"),
    ]
    for df, name in results:
        assert df.schema[name].dataType.simpleString() == "bigint"
        assert {r[0] for r in df.select(name).collect()} == {BIG, None}


def test_ids_like_a_plain_call_on_awkward_letters():
    plain = Tokenizer.from_file(PATH)
    draw = random.Random(9)
    parts = list("aIE.,'_-! \t\nİıΣσß́É  ") + ["<|endoftext|>", "<|", "'s", "ab", " x "]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 12))) for _ in range(30_000)]
    texts += ["Aİ.", "İ, b", "<|startoftext|>x"]
    got = Encoder(PATH).encode_many(texts)
    for text, ids in zip(texts, got, strict=True):
        want = plain.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == want, text
    assert zlib.crc32(got[0]) >= 0


def test_memory_is_given_back_once_after_all_batches(monkeypatch):
    told = []
    monkeypatch.setattr(tables, "_trim", lambda: told.append("trim"))

    @tables.giving_back
    def double(batches):
        for b in batches:
            yield 2 * b

    for x in double(iter([1, 2])):
        told.append(x)
    assert told == [2, 4, "trim"]
    monkeypatch.undo()
    tables._trim()
