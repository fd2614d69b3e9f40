"""Token-id output: best-fit-decreasing packing of texts into rows of a fixed width.

Each task packs the texts of its partition as they come, a bounded number of tokens at a
time: no shuffle, and memory does not grow with the partition. The longest piece first,
each goes to the sequence with the least space that still holds it, found by a segment
tree over the free spaces. Only texts beyond the width are cut, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.tables import id_as_text, table, texts_of
from tierflow.llm.token_ids import Encoder, pieces_of

SCHEMA = (
    "sequence_id long, n_tokens int, n_segments int, doc_ids array<long>, pieces array<int>, "
    "starts array<long>, cu_seqlens array<int>, position_resets array<int>, ids binary"
)


@dataclass(frozen=True)
class Settings:
    """``buffer_tokens``: tokens that are packed together; the more, the fuller the rows.
    ``id_type``: numpy type of the stored ids, wide enough for the vocabulary."""

    capacity: int = 2048
    buffer_tokens: int = 1 << 21
    pad_id: int = 0
    id_type: str = "<u2"


class FreeSpace:
    """Segment tree over free sizes 0..capacity with the number of sequences of each."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, size: int, n: int) -> None:
        at = size + self.width
        while at:
            self.count[at] += n
            at >>= 1

    def least(self, size: int) -> int:
        """The smallest free size of at least ``size`` that some sequence has, or -1."""
        at = size + self.width
        if self.count[at]:
            return size
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.width
            at >>= 1
        return -1


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the items in each sequence, longest items first; ties keep their order."""
    space = FreeSpace(capacity)
    by_size: dict[int, list[list[int]]] = {}
    sequences = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = space.least(lengths[i])
        if size < 0:
            size, sequence = capacity, []
            sequences.append(sequence)
        else:
            sequence = by_size[size].pop()
            space.add(size, -1)
        sequence.append(i)
        rest = size - lengths[i]
        by_size.setdefault(rest, []).append(sequence)
        space.add(rest, 1)
    return sequences


def _packed(found: list[tuple], s: Settings, first: int) -> pd.DataFrame:
    """Output rows for pieces ``(doc_id, number, start, ids)``, numbered from ``first``."""
    rows = []
    for n, items in enumerate(best_fit_decreasing([len(p[3]) // 4 for p in found], s.capacity)):
        parts = [found[i] for i in items]
        ids = np.frombuffer(b"".join(p[3] for p in parts), "<u4")
        ends = np.cumsum([len(p[3]) // 4 for p in parts])
        matrix_row = np.full(s.capacity, s.pad_id, s.id_type)
        matrix_row[: len(ids)] = ids
        cuts = [0, *ends.tolist()]
        rows.append(
            (
                first + n, len(ids), len(parts), [p[0] for p in parts], [p[1] for p in parts],
                [p[2] for p in parts], cuts, cuts[:-1], matrix_row.tobytes(),
            )
        )
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def packed_ids(documents: DataFrame, tokenizer: str, s: Settings = Settings()) -> DataFrame:
    """One row for each sequence of ``capacity`` ids, padded at the end with ``pad_id``.

    ``cu_seqlens`` has where segments begin and where the last one ends, ``position_resets``
    where positions start from 0 again; ``doc_ids``, ``pieces`` and ``starts`` tell which
    part of which text each segment is. Every text ends with id 0. Null and empty texts
    are that id alone; a null doc_id stays null; repeated rows are packed each; other
    columns are ignored; an empty table gives no rows.
    """
    if s.capacity < 1:
        raise ValueError("capacity must be positive")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer)
        if encoder.tokenizer.get_vocab_size() - 1 > np.iinfo(s.id_type).max:
            raise ValueError(f"{s.id_type} is too narrow for the vocabulary")
        buffer, held, sequence = [], 0, TaskContext.get().partitionId() << 33
        for batch in batches:
            docs = [None if d is None else int(d) for d in batch["doc_id"]]
            texts = batch["text"].tolist()
            for doc, ids in zip(docs, encoder.encode_many(texts), strict=True):
                for number, start, part in pieces_of(ids, s.capacity):
                    buffer.append((doc, number, start, part))
                    held += len(part) // 4
                    if held >= s.buffer_tokens:
                        out = _packed(buffer, s, sequence)
                        sequence, buffer, held = sequence + len(out), [], 0
                        yield out
        if buffer:
            yield _packed(buffer, s, sequence)

    rows = id_as_text(texts_of(documents).select("doc_id", "text"), "doc_id")
    return rows.mapInPandas(run, SCHEMA)


def matrix(rows: pd.DataFrame, s: Settings = Settings()) -> np.ndarray:
    """The id matrix of output rows."""
    return np.frombuffer(b"".join(rows["ids"]), s.id_type).reshape(-1, s.capacity)


def positions(cu_seqlens: list[int], capacity: int) -> np.ndarray:
    """Position ids of one row: each segment counts from 0, padding is 0."""
    out = np.zeros(capacity, np.int32)
    for a, b in zip(cu_seqlens, cu_seqlens[1:]):
        out[a:b] = np.arange(b - a)
    return out


def op3_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed_ids(table(spark, sf_dir, "documents"), path)
