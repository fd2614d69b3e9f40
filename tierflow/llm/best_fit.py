"""Bulk-synchronous best-fit packing of all texts into sequences of a fixed capacity.

Lengths and gaps are whole numbers up to the capacity. Spark sorts and numbers the texts
within their lengths; the rounds then work on runs of equal length, of which there are no
more than the capacity allows, and of equal gap, of which each match leaves at most one,
whatever the number of texts. A round
sweeps both in order: each run of texts goes for its successor, the smallest gap that
holds it. Where runs want the same gap, the longer texts rank first and the rest waits;
short texts of a run stack up in a gap. Texts that no gap holds open new sequences.
Matched gaps shrink, and the next round starts. Rounds go down the lengths by halves, so
that short texts fill what long ones have left. A last join tells each text its place.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.llm.tables import stored, table, texts_of
from tierflow.llm.token_ids import pieces
MATCH = "length long, lo long, n long, stack long, seq_lo long, at long"


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048


class Match(NamedTuple):
    """Texts number ``lo`` on of a length: ``stack`` of them each go to the ``n`` sequences
    from ``seq_lo`` on, one behind the other from offset ``at``."""

    length: int
    lo: int
    n: int
    stack: int
    seq_lo: int
    at: int


class Rounds:
    """Runs of texts not yet placed, ``{length: [first number, how many]}``, and runs of
    sequences by their gap, ``{gap: [(first sequence, how many), ...]}``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.texts = {length: [0, n] for length, n in counts.items()}
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.opened = 0

    def run(self) -> list[Match]:
        found = []
        floor = self.capacity // 2
        while self.texts:
            while max(self.texts) <= floor:
                floor //= 2
            active = [length for length in self.texts if length > floor]
            found += self.round(sorted(active, reverse=True))
        return found

    def round(self, lengths: list[int]) -> list[Match]:
        """One sweep over the given lengths, longest first."""
        sizes = sorted(self.gaps)
        wanted: dict[int, list[int]] = {}
        homeless = []
        for length in lengths:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                wanted.setdefault(sizes[at], []).append(length)
            else:
                homeless.append(length)
        met = [m for gap, rank in wanted.items() for m in self._fill(gap, rank)]
        met += self._open(homeless)
        self._shrink(met)
        return met

    def _take(self, length: int, n: int) -> int:
        run = self.texts[length]
        first = run[0]
        run[0], run[1] = first + n, run[1] - n
        if not run[1]:
            del self.texts[length]
        return first

    def _fill(self, gap: int, rank: list[int]) -> list[Match]:
        """The gap's sequences go to the runs in their rank; what fills no whole gap shares one."""
        free, met, blocks = self.gaps.pop(gap), [], []
        at = self.capacity - gap
        for length in rank:
            stack = gap // length
            whole = self.texts[length][1] // stack
            while whole and free:
                seq, n = free.pop()
                used = min(whole, n)
                met.append(Match(length, self._take(length, used * stack), used, stack, seq, at))
                whole -= used
                if used < n:
                    free.append((seq + used, n - used))
            rest = self.texts.get(length, (0, 0))[1]
            if not whole and rest:
                blocks.append((length, rest))
        room, here = 0, -1
        for length, n in blocks:
            if n * length > room:
                if not free:
                    continue
                here, left = free.pop()
                if left > 1:
                    free.append((here + 1, left - 1))
                room = gap
            met.append(Match(length, self._take(length, n), 1, n, here, self.capacity - room))
            room -= n * length
        if free:
            self.gaps[gap] = free
        return met

    def _open(self, rank: list[int]) -> list[Match]:
        """Sequences for the longest homeless texts: one for each that cannot share, and
        for the others as many as their tokens fill at least."""
        runs = [(length, self.texts[length][1]) for length in rank]
        long = sum(n for length, n in runs if length > self.capacity // 2)
        quota = max(long, -(-sum(length * n for length, n in runs) // self.capacity))
        met = []
        for length, n in runs:
            n = min(n, quota - sum(m.n for m in met))
            if n > 0:
                met.append(Match(length, self._take(length, n), n, 1, self.opened, 0))
                self.opened += n
        return met

    def _shrink(self, met: list[Match]) -> None:
        """The sequences that got texts, by what is left of their gaps."""
        ends: dict[tuple[int, int], int] = {}
        for m in met:
            ends[m.seq_lo, m.n] = max(ends.get((m.seq_lo, m.n), 0), m.at + m.stack * m.length)
        for (seq, n), end in ends.items():
            if end < self.capacity:
                self.gaps.setdefault(self.capacity - end, []).append((seq, n))


def places(lengths: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Matches for the counts ``(length, n)`` of texts; at most one line for each length."""
    counts = {r["length"]: r["n"] for r in lengths.collect()}  # as many as the capacity at most
    found = Rounds(counts, s.capacity).run()
    return lengths.sparkSession.createDataFrame(found, MATCH)


def pack(found: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``sequence_id`` and ``offset`` for each piece ``(_row, piece, length, ...)``.

    Pieces of a length are numbered within source partitions first and the partitions'
    counts then added up, so that one frequent length is no single task's work.
    """
    found = found.withColumn("part", F.shiftright("_row", 33))
    counts = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part")
    counts = counts.withColumn("before", F.sum("n").over(before) - F.col("n"))
    plan = stored(places(counts.groupBy("length").agg(F.sum("n").alias("n")), s), "places")
    inside = W.partitionBy("length", "part").orderBy("_row", "piece")
    numbered = (
        found.withColumn("number", F.row_number().over(inside) - 1)
        .join(counts.select("length", "part", "before"), ["length", "part"])
        .withColumn("number", F.col("number") + F.col("before"))
        .drop("before", "part")
    )
    p = plan.select(
        F.col("length").alias("p_length"),
        "lo",
        (F.col("lo") + F.col("n") * F.col("stack")).alias("hi"),
        "stack",
        "seq_lo",
        "at",
    )
    behind = F.col("number") - F.col("lo")
    return numbered.join(
        p,
        (F.col("length") == F.col("p_length"))
        & (F.col("number") >= F.col("lo"))
        & (F.col("number") < F.col("hi")),
    ).select(
        *[c for c in numbered.columns if c != "number"],
        (F.col("seq_lo") + F.call_function("div", behind, F.col("stack"))).alias("sequence_id"),
        (F.col("at") + F.pmod(behind, F.col("stack")) * F.col("length")).alias("offset"),
    )


def pack_documents(documents: DataFrame, tokenizer: str, s: Settings = Settings()) -> DataFrame:
    """The pieces of all texts with their sequences and offsets, one row each.

    A null or empty text is one piece, its end id. Repeated rows and rows without id are
    packed each. Other columns are ignored. An empty table gives no rows. Only texts
    beyond the capacity are cut.
    """
    found = stored(pieces(texts_of(documents), tokenizer, s.capacity), "pieces")
    return pack(found, s).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(table(spark, sf_dir, "documents"), path)
