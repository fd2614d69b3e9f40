"""Packing: exact round trips, no overlaps, and close to the plain best fit."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierflow.llm import best_fit, packed_ids, tables
from tierflow.llm.token_ids import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World! it's \u00c9t\u00e9 caf\u00e9 123",
    "odd\u00a0space\x1cand\u2003more  x",
    "<|endoftext|> stays text <|startoftext|>",
    "e\u0301 \u0301 \u212b \u0130stanbul \u03a3\u03a3 \ufb01",
    "word " * 700,
    "",
    "\n\t ",
    "a'll b'S c're",
    "no., yes... a.b 1.5, x,.y (z). _. q_ end.\u0301 \u03a3. \u00bd, \u00b2.",
    "Word, word. WORD's, d'Or. l'\u00e9t\u00e9, 3.14.",
]
ROWS = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (0, TEXTS[0], "x"), (9, "word " * 700, "x")]
SCHEMA = "doc_id long, text string, piece string"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_words_apart_like_whole_texts(plain):
    got = Encoder(PATH).encode_many(TEXTS)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t)[:-1] for t in TEXTS]


def test_documents_packed_without_loss(spark, plain):
    s = best_fit.Settings(capacity=64)
    rows = best_fit.pack_documents(spark.createDataFrame(ROWS, SCHEMA), PATH, s).collect()
    want = []
    for doc, text, _ in ROWS:
        ids = plain(text)
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start : start + 64], "<u4").tobytes()
            want.append((doc, piece, start, len(part) // 4, zlib.crc32(part)))
    key = str
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_rounds_place_every_text_once(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    met = best_fit.Rounds(counts, 50).run()
    placed, cells = set(), set()
    for m in met:
        for i in range(m.n):
            for k in range(m.stack):
                text = (m.length, m.lo + i * m.stack + k)
                assert text not in placed
                placed.add(text)
                for c in range(m.at + k * m.length, m.at + (k + 1) * m.length):
                    assert c < 50 and (m.seq_lo + i, c) not in cells
                    cells.add((m.seq_lo + i, c))
    assert placed == {(n, k) for n, c in counts.items() for k in range(c)}
    used = len({q for q, _ in cells})
    best = len(packed_ids.best_fit_decreasing(lengths, 50))
    assert used <= best * 1.25 + 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing_like_a_plain_scan(lengths):
    got = packed_ids.best_fit_decreasing(lengths, 40)
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b + n <= 40]
        if fits:
            bins.remove(max(fits))
            bins.append(max(fits) + n)
        else:
            bins.append(n)
    assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(bins)
    assert sorted(i for b in got for i in b) == list(range(len(lengths)))


def test_id_rows_round_trip(spark, plain):
    s = packed_ids.Settings(capacity=64, buffer_tokens=300)
    rows = packed_ids.packed_ids(spark.createDataFrame(ROWS, SCHEMA), PATH, s).toPandas()
    ids = packed_ids.matrix(rows, s)
    assert ids.shape == (len(rows), 64) and rows["sequence_id"].is_unique
    found = []
    for i, r in enumerate(rows.itertuples()):
        cuts = list(r.cu_seqlens)
        assert cuts[0] == 0 and cuts[-1] == r.n_tokens and list(r.position_resets) == cuts[:-1]
        assert (ids[i, r.n_tokens :] == s.pad_id).all()
        assert (packed_ids.positions(cuts, 64)[cuts[:-1]] == 0).all()
        for k in range(r.n_segments):
            doc = r.doc_ids[k]
            doc = None if doc is None or np.isnan(doc) else int(doc)
            found.append((doc, r.starts[k], ids[i, cuts[k] : cuts[k + 1]].tolist()))
    want = [
        (doc, a, plain(text)[a : a + 64]) for doc, text, _ in ROWS for a in range(0, len(plain(text)), 64)
    ]
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("run", [best_fit.pack_documents, packed_ids.packed_ids])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_encoders_go_when_a_worker_turns_to_training():
    first = Encoder.of(PATH)
    assert Encoder.of(PATH) is first
    tables.let_go()
    again = Encoder.of(PATH)
    assert again is not first and again.encode_many(["some words"]) == first.encode_many(["some words"])


def test_an_encoder_keeps_few_words():
    encoder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(0, 400_000, 50_000):
        encoder.encode_many([" ".join(f"w{i}" for i in range(k, k + 50_000))])
    assert len(encoder.cache) + len(encoder.older) <= 350_000
