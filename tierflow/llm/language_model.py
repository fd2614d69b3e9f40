"""Language-model scores from a weighted backoff automaton.

Words are the automaton's symbols. Every context has a state with an arc for each word
seen after it, weighted by its smoothed probability, and a failure arc to the shorter
context, weighted by what smoothing leaves for unseen words; the empty context ends in an
arc for all unknown words. A text is read once from left to right: the state is carried
along, and weights of arcs and failures add up to its log probability.

No task holds the whole model. Texts are taken in blocks; a block asks the shards of the
count table for its own words and word pairs, and from the answers builds the part of the
automaton that its texts can reach. Both ways move one entry for each distinct word or
pair of a block, so a frequent pair costs one entry in each block and no shard is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import id_as_long, id_as_text, stored, table, texts_of
from tierflow.llm.words import mix, word_hashes

_U = np.uint64
# Symbols beside the words; hashes of words hit them with a chance of 2**-64 each.
END = _U(0x5EED0E0D00000001)
START = _U(0x5EED0E0D00000002)


@dataclass(frozen=True)
class Settings:
    """``prior``: how many observations the shorter context counts for in each context.
    ``block_rows``: texts of a block; a text of more than ``long_chars`` is its own block.
    ``shard_chars``: characters of text for which the count table gets one more part."""

    prior: float = 300.0
    block_rows: int = 4096
    long_chars: int = 1 << 16
    shard_chars: int = 1 << 24


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words, each text followed by the end symbol, and where each text begins."""
    words, at = word_hashes([t.encode("utf-8", "surrogatepass") for t in texts])
    n = np.diff(at) + 1
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.full(begin[-1], END, _U)
    inside = np.ones(len(out), bool)
    inside[begin[1:] - 1] = False
    out[inside] = words
    return out, begin


def _pairs(symbols: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The hash of each symbol with the one before it, or with the start."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[begin[:-1]] = START
    return mix(before * _U(0x9E3779B97F4A7C15) + symbols)


def _keys(symbols: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words and pairs, sorted, and the index of each symbol in them."""
    words, at_word = np.unique(symbols, return_inverse=True)
    pairs, at_pair = np.unique(_pairs(symbols, begin), return_inverse=True)
    return words, at_word, pairs, at_pair


def _shard_cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range begins in sorted keys."""
    bounds = (np.arange(1, shards, dtype=_U) * _U((1 << 64) // shards)).astype(_U)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(block, texts, which train) of a partition's rows, which come block by block."""
    now, texts, flags = None, [], []
    for batch in batches:
        for block, text, train in zip(batch["block"], batch["text"], batch["train"], strict=True):
            if block % 2:  # a long text
                yield block, [text], np.array([train], bool)
                continue
            if block != now and texts:
                yield now, texts, np.array(flags, bool)
                texts, flags = [], []
            now = block
            texts.append(text)
            flags.append(train)
    if texts:
        yield now, texts, np.array(flags, bool)


def requests(rows: DataFrame, shards: int) -> DataFrame:
    """``(block, kind, shard, keys, counts)``: what a block needs, with its training counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, texts, train in _blocks(batches):
            symbols, begin = _symbols(texts)
            used = np.repeat(train, np.diff(begin))
            out = []
            words, at_word, pairs, at_pair = _keys(symbols, begin)
            for kind, keys, at in ((0, words, at_word), (1, pairs, at_pair)):
                counts = np.bincount(at[used], minlength=len(keys)).astype(np.uint32)
                cuts = _shard_cuts(keys, shards)
                for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if a < b:
                        out.append((block, kind, shard, keys[a:b].tobytes(), _small(counts[a:b])))
            yield pd.DataFrame(out, columns=["block", "kind", "shard", "keys", "counts"])

    schema = "block long, kind int, shard int, keys binary, counts binary"
    return rows.select("block", "text", "train").mapInPandas(run, schema)


def _small(counts: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, its width in front."""
    top = int(counts.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], f"<u{data[0]}").astype(np.int64)


def answers(asked: DataFrame) -> DataFrame:
    """``(block, kind, shard, counts)`` over all training texts, in the order of the keys.

    Where a file is split inside a block, each of the tasks asks for the keys of its share;
    the block gets one answer, on the keys of all of them. The line of block -1 has the shard's own totals: tokens, distinct ones, and those
    seen once and twice.
    """

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        kind, shard = key
        keys = [np.frombuffer(k, _U) for k in group["keys"]]
        counts = np.concatenate([_large(c) for c in group["counts"]])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, counts, len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        wanted: dict[int, np.ndarray] = {}
        for block, places in zip(group["block"], np.split(at, ends[:-1]), strict=True):
            wanted[block] = np.union1d(wanted[block], places) if block in wanted else places
        given = [_small(total[places]) for places in wanted.values()]
        facts = np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()])
        return pd.DataFrame(
            {
                "block": [*wanted, -1],
                "kind": kind,
                "shard": shard,
                "counts": [*given, facts.astype("<i8").tobytes()],
            }
        )

    return asked.groupBy("kind", "shard").applyInPandas(
        run, "block long, kind int, shard int, counts binary"
    )


@dataclass(frozen=True)
class Totals:
    """Training tokens, distinct ones, the training texts, and the discount of a word's count."""

    tokens: int
    distinct: int
    texts: int
    discount: float

    def unigram(self, count: np.ndarray) -> np.ndarray:
        """Absolute discounting; what it takes from known words goes to the unknown one."""
        spared = self.discount * self.distinct / self.tokens if self.tokens else 1.0
        return np.where(count > 0, (count - self.discount) / max(self.tokens, 1), spared)


class Automaton:
    """States 0 (empty context) and 1.. (one word, or the start), as far as a block needs them.

    ``arc``: weight of each (state, symbol) pair that was seen, by its number; ``known``
    says which were. ``fail``: weight of each state's failure arc to state 0. ``root``:
    weight of each symbol's arc at state 0.
    """

    def __init__(self, word_count, pair_count, pair_from, pair_to, totals: Totals, s: Settings):
        context = np.append(word_count, totals.texts)  # the last state is the start
        lower = totals.unigram(word_count)
        self.root = np.log10(lower)
        self.fail = np.log10(s.prior / (context + s.prior))
        self.arc = np.log10((pair_count + s.prior * lower[pair_to]) / (context[pair_from] + s.prior))
        self.known = pair_count > 0

    def read(self, symbols: np.ndarray, pair: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The weight each symbol adds: its arc from the state carried to it, or the
        failure arc and then the arc of the empty context."""
        return np.where(self.known[pair], self.arc[pair], self.fail[state] + self.root[symbols])


def score_block(texts: list[str], given: dict[tuple[int, int], bytes], totals: Totals, s: Settings, shards: int):
    """``(n_tokens, n_known, base_score, score)`` of a block's texts."""
    symbols, begin = _symbols(texts)
    words, at_word, pairs, at_pair = _keys(symbols, begin)
    counts = []
    for kind, keys in ((0, words), (1, pairs)):
        cuts = _shard_cuts(keys, shards)
        parts = [_large(given[kind, k]) for k in range(shards) if cuts[k] < cuts[k + 1]]
        counts.append(np.concatenate(parts))
    word_count, pair_count = counts
    # The state after each symbol: the word just read, or the start before a text's first.
    state = np.empty(len(symbols), np.int64)
    state[1:] = at_word[:-1]
    state[begin[:-1]] = len(words)
    pair_from, pair_to = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
    pair_from[at_pair], pair_to[at_pair] = state, at_word
    model = Automaton(word_count, pair_count, pair_from, pair_to, totals, s)
    weight = model.read(at_word, at_pair, state)
    known = word_count[at_word]
    base = np.log10((known + 1) / (totals.tokens + totals.distinct + 1))
    first = begin[:-1]
    return (
        np.diff(begin),
        np.add.reduceat((known > 0).astype(np.int64), first),
        np.add.reduceat(base, first),
        np.add.reduceat(weight, first),
    )


def blocked(documents: DataFrame, s: Settings) -> DataFrame:
    """``documents`` (_row, doc_id, text) with their block, and whether they train."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    long = F.length("text") > s.long_chars
    # Row numbers count up within a file, so a block's rows stand together.
    block = F.when(long, F.col("_row") * 2 + 1).otherwise(
        F.call_function("div", "_row", F.lit(s.block_rows)) * (2 * s.block_rows)
    )
    return documents.select(
        "*",
        block.alias("block"),
        F.coalesce(remainder != 2, F.lit(True)).alias("train"),
    )


def language_model_scores(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Scores for every row of ``(doc_id, text)`` under a model of the rows that train.

    A null or empty text is its end alone. A null id trains and is not held out. Repeated
    rows all count. Without training texts every symbol is unknown. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = blocked(texts_of(documents), s)
    size = rows.agg(F.sum(F.length("text").cast("long")), F.sum(F.col("train").cast("long"))).first()
    shards, n_texts = max(4, -(-(size[0] or 0) // s.shard_chars)), size[1] or 0
    got = stored(answers(requests(rows, shards)), "counts")
    facts = np.zeros((2, 4), np.int64)
    for r in got.where("block = -1").select("kind", "counts").collect():  # a line for each shard
        facts[r["kind"]] += np.frombuffer(r["counts"], "<i8")
    tokens, distinct, once, twice = facts[0].tolist()
    discount = once / (once + 2 * twice) if once and twice else 0.5
    totals = Totals(tokens, distinct, n_texts, discount)

    def run(key: tuple, texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if texts.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        given = {(k, h): c for k, h, c in zip(found["kind"], found["shard"], found["counts"], strict=True)}
        n, known, base, score = score_block(texts["text"].tolist(), given, totals, s, shards)
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"],
                "held_out": ~texts["train"],
                "n_tokens": n,
                "n_known": known,
                "train_tokens": totals.tokens,
                "base_score": base,
                "score": score,
            }
        )

    schema = (
        "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    theirs = got.where("block >= 0").groupBy("block")
    scored = id_as_text(rows, "doc_id").groupBy("block").cogroup(theirs).applyInPandas(run, schema)
    return id_as_long(scored, "doc_id")


def op2_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))
