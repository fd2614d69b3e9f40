"""Grouping of spelling variants by Bloom-guided neighbourhoods.

Two words are near if they differ by one inserted, deleted or replaced character. Every word
of the vocabulary generates its edits; an edit is a word only if the Bloom filter of all
words of its length has it, so only what the filters let pass, true neighbours and a few
in a thousand others, is shuffled to an exact join with the vocabulary.

An inserted character is a deleted one seen from the other word, and of two words that differ
in one character the one with the smaller character generates the other: each pair is
generated once. Edits are never spelled out to be probed: the hash is a polynomial in the
characters, so that of an edit follows from that of its word.

The filters are blocked: a word sets its bits in one 64-bit block, and all blocks of all
lengths lie in one sequence, length by length. At most ``filter_bytes`` of it are
broadcast at once; a larger vocabulary is probed in several passes over slices of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters once A to Z are lower case.
RUN = "[a-zÀ-ÿ]+"
#: Any odd number has an inverse modulo 2^64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BITS = 5


@dataclass(frozen=True)
class Settings:
    """``least``: occurrences that make a word; ``shortest``: characters; ``ratio``: how many
    times as frequent a form is. ``slip``: one run in so many loses a character.

    ``filter_bytes`` are broadcast at once, ``block_words`` share a block on average and
    ``task_words`` are probed by a task.
    """

    least: int = 5
    shortest: int = 6
    ratio: int = 5
    slip: int | None = None
    filter_bytes: int = 32 << 20
    block_words: int = 4
    task_words: int = 16_384


# --- words -----------------------------------------------------------------------


def slipped(run: Column, doc_id: Column, one_in: int) -> Column:
    """``run``, without one of its characters where the checksum of id and run says so."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    crc = F.crc32(name.cast("binary"))
    at = (crc % F.length(run)).cast("int")
    rest = F.substring(run, at + 2, F.length(run))
    return F.when(crc % one_in == 0, F.concat(F.substring(run, F.lit(1), at), rest)).otherwise(run)


def vocabulary(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``word, n``: the frequent words of ``(doc_id, text)`` and their occurrences."""
    text = F.translate("text", UPPER, LOWER)
    runs = documents.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= s.shortest)
    word = F.col("run") if s.slip is None else slipped(F.col("run"), F.col("doc_id"), s.slip)
    words = runs.select(word.alias("word")).where(F.length("word") >= s.shortest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= s.least)


# --- hashes and filters ------------------------------------------------------------


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))]).astype(np.uint64)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _block_and_bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``blocks`` a hash belongs to, and the bits it has there."""
    h = _mixed(h)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros_like(h)
    for k in range(_BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), bits


def _hashes(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (codes * _powers(codes.shape[1])[:-1]).sum(1, dtype=np.uint64)


@dataclass(frozen=True)
class Shards:
    """Where the blocks of each word length lie: ``first[length]`` and how many."""

    first: dict[int, int]
    blocks: dict[int, int]

    @classmethod
    def of(cls, counts: dict[int, int], s: Settings) -> Shards:
        first, blocks, at = {}, {}, 0
        for length, n in sorted(counts.items()):
            # Blocks are picked by a 32-bit number; more words share them beyond that.
            first[length], blocks[length] = at, min(-(-n // s.block_words), 1 << 31)
            at += blocks[length]
        return cls(first, blocks)

    @property
    def size(self) -> int:
        return sum(self.blocks.values())


def _same_length(words: pd.Series, cells: int = 1 << 18) -> Iterator[np.ndarray]:
    """Positions of words of one length, at most ``cells`` characters of them at a time."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, cells // int(length))
        yield from (at[k : k + step] for k in range(0, len(at), step))


def bloom(words: DataFrame, shards: Shards) -> DataFrame:
    """``block, bits`` of all words; ``block`` counts through all shards."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _same_length(batch["word"]):
                codes = _codes(batch["word"].iloc[part].tolist())
                length = codes.shape[1]
                block, bits = _block_and_bits(_hashes(codes), shards.blocks[length])
                yield pd.DataFrame({"block": block + shards.first[length], "bits": bits.view(np.int64)})

    set_bits = words.select("word").mapInPandas(run, "block long, bits long")
    return set_bits.groupBy("block").agg(F.bit_or("bits").alias("bits"))


@dataclass(frozen=True)
class Slice:
    """Blocks from ``lo`` on, of the whole sequence."""

    shards: Shards
    lo: int
    bits: np.ndarray

    def reaches(self, length: int) -> bool:
        first = self.shards.first.get(length)
        return first is not None and first < self.lo + len(self.bits) and first + self.shards.blocks[length] > self.lo

    def has(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Whether words of ``length`` may have these hashes; False for blocks of other slices."""
        block, bits = _block_and_bits(hashes, self.shards.blocks[length])
        at = block + (self.shards.first[length] - self.lo)
        inside = (at >= 0) & (at < len(self.bits))
        at[~inside] = 0
        return inside & (self.bits[at] & bits == bits)


def edits(words: list[str], alphabet: np.ndarray, found: Slice) -> Iterator[tuple[int, str]]:
    """Index of a word and its edit, for words of one length and every edit that ``found`` may have."""
    codes = _codes(words)
    length = codes.shape[1]
    power = _powers(length)
    with np.errstate(over="ignore"):
        terms = codes * power[:-1]
        whole = terms.sum(1, dtype=np.uint64)
        if found.reaches(length - 1):
            head = np.cumsum(terms, 1, dtype=np.uint64)
            left_out = head - terms + (whole[:, None] - head) * _INVERSE
            hit = found.has(left_out, length - 1)
            hit[:, 1:] &= codes[:, 1:] != codes[:, :-1]  # one of equal characters in a row
            for w, i in zip(*np.nonzero(hit), strict=True):
                yield w, words[w][:i] + words[w][i + 1 :]
        if found.reaches(length):
            for letter in alphabet.tolist():
                w, i = np.nonzero(codes < letter)
                put = whole[w] + (np.uint64(letter) - codes[w, i]) * power[i]
                hit = found.has(put, length)
                for w, i in zip(w[hit], i[hit], strict=True):
                    yield w, words[w][:i] + chr(letter) + words[w][i + 1 :]


def candidates(words: DataFrame, n_words: int, alphabet: np.ndarray, found: Slice, s: Settings) -> DataFrame:
    """``word, n, near``: edits of the words that the slice of the filters lets pass."""
    # A word has some thousand edits, so words are dealt by their number, not their bytes.
    dealt = words.repartition(-(-n_words // s.task_words), "word")
    shared = words.sparkSession.sparkContext.broadcast(found)  # at most filter_bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _same_length(batch["word"]):
                rows = batch.iloc[part]
                made = list(edits(rows["word"].tolist(), alphabet, shared.value))
                if made:
                    at = [w for w, _ in made]
                    yield rows.iloc[at].assign(near=[near for _, near in made])

    return dealt.mapInPandas(run, "word string, n long, near string")


def neighbours(words: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``word, n, near, near_n``: every pair of near words of ``(word, n)``, both ways."""
    spark = words.sparkSession
    counts = words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    shards = Shards.of({r["length"]: r["n"] for r in counts}, s)
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").distinct()
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters.collect()), np.uint64)  # at most 90
    blocks = stored(bloom(words, shards), "bloom")
    step = max(1, s.filter_bytes // 8)
    found = None
    for lo in range(0, shards.size, step):
        bits = np.zeros(min(step, shards.size - lo), np.uint64)
        part = blocks.where(F.col("block").between(lo, lo + len(bits) - 1)).toPandas()
        bits[part["block"].to_numpy() - lo] = part["bits"].to_numpy().astype(np.int64).view(np.uint64)
        made = candidates(words, sum(r["n"] for r in counts), alphabet, Slice(shards, lo, bits), s)
        made = stored(made, "candidates")
        found = made if found is None else found.unionByName(made)
    if found is None:
        found = words.select("word", "n", F.col("word").alias("near")).limit(0)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = stored(found.join(known, "near").select("word", "n", "near", "near_n"), "pairs")
    back = pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    return pairs.unionByName(back)


# --- forms -----------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``(word, form)``: forms followed to the last, twice as far each round.

    A form is ``ratio`` times as frequent as its word, so chains are short and end.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(on, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_groups(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every frequent word of ``(doc_id, text)``.

    ``form`` is the near word with the most occurrences (of equals the first in code-point
    order), if it has ``ratio`` times as many as the word; else it and ``form_n`` are null.
    ``root`` is where the forms lead. Null and empty texts have no words; a null id counts
    as an empty one; repeated rows count each; other columns are ignored; no frequent word
    gives no rows.
    """
    words = stored(vocabulary(documents.select("doc_id", "text"), s), "words")
    # A word has a bounded number of near words, so no group is large.
    best = neighbours(words, s).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best")
    )
    known = words.join(best, "word", "left")
    fits = -F.col("best.col1") >= s.ratio * F.col("n")
    known = known.select(
        "word",
        F.when(fits, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, -F.col("best.col1")).alias("form_n"),
    )
    known = stored(known, "forms")
    roots = _roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), Settings(slip=199))
