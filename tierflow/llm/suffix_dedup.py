"""Repeated byte strings by prefix doubling from sampled suffixes.

Wanted is every position whose next 400 bytes also start somewhere else. Sorting all
suffixes would move each byte's position and rank at every offset, many times the text
itself. The suffix array is sampled instead, so that equal strings have equal samples: of
each 400-byte window, the position with the smallest hash of its 80 bytes (the leftmost
one of equals) is the window's owner. Windows can only be equal if their owners are.

A position stands for the run of windows it owns. Round by round, runs are ranked by
longer strings (a rank is the string's 64-bit hash, grouped by Spark together with the
rank before), and whatever is unique, or as long as all its windows together and not
unique, is settled:

1. 80 bytes at the owner: alone, no window of the run is repeated.
2. The owner with all bytes of its run: equal runs are repeated as a whole. Runs that
   differ but share their 80 bytes go on, one of each kind.
3. Pieces of 16 windows: a piece that is found twice is repeated, and one whose common
   bytes (385) are unique is not.
4. Single windows of 400 bytes in the pieces left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import few, free_name, giving_back, numbered, stored, table
from tierflow.llm.words import _BYTE, _Powers, mix

_U = np.uint64
SEGMENT = 1 << 18
# Rows that a task gathers before it passes them on.
AT_ONCE = 8192
_LOW = _U(0xFFFFFFFF)


@dataclass(frozen=True)
class Settings:
    """``length``: bytes of a string that counts. ``sample``: bytes whose hash picks owners,
    at most ``length``. ``piece``: windows of a piece, less than ``length``."""

    length: int = 400
    sample: int = 80
    piece: int = 16


def _owners(buffer: np.ndarray, s: Settings) -> np.ndarray:
    """The owner's position of each window of ``length`` bytes."""
    n = len(buffer)
    up, down = _Powers.get(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[buffer] * up[:n], out=total[1:])
    hashes = mix((total[s.sample :] - total[: -s.sample]) * down[: n - s.sample + 1])
    # Hash above, position below: the least of these is the leftmost of equal hashes.
    key = (hashes & ~_LOW) | np.arange(len(hashes), dtype=_U)
    width = s.length - s.sample + 1
    full = np.concatenate([key, np.full(-len(key) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    windows = n - s.length + 1
    return (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _LOW).astype(np.int64)


def _parts(texts: list[bytes], s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buffer, text of each window, position of the buffer's bytes in their text) of texts
    long enough, together about ``SEGMENT`` bytes; longer texts in overlapping segments."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - s.length + 1, 0), SEGMENT):
            held.append((i, at, text[at : at + SEGMENT + s.length - 1]))
            size += len(held[-1][2])
            if size >= SEGMENT:
                yield _together(held, s)
                held, size = [], 0
    if held:
        yield _together(held, s)


def _together(held: list[tuple[int, int, bytes]], s: Settings):
    sizes = np.array([len(b) for _, _, b in held])
    begin = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(b for _, _, b in held), np.uint8)
    n = sizes - s.length + 1  # windows that lie within one text
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
    text = np.repeat([i for i, _, _ in held], n)
    shift = np.repeat([at for _, at, _ in held] - begin, n)
    return buffer, window, text, shift


def owned_runs(texts: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, last window, owner) of all runs, positions within the text."""
    found = [[], [], [], []]
    for buffer, window, text, shift in _parts(texts, s):
        owner = _owners(buffer, s)[window]
        new = np.ones(len(window), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(window) - 1)
        for k, column in enumerate((text[first], (window + shift)[first], (window + shift)[last], (owner + shift)[first])):
            found[k].append(column)
    text, lo, hi, pos = (np.concatenate(c) if c else np.empty(0, np.int64) for c in found)
    # A run that a segment's border cut is one run again.
    again = np.zeros(len(text), bool)
    again[1:] = (text[1:] == text[:-1]) & (pos[1:] == pos[:-1])
    first = np.flatnonzero(~again)
    last = np.append(first[1:] - 1, len(text) - 1) if len(text) else first
    return text[first], lo[first], hi[last], pos[first]


def _hash(data: bytes, seed: int = 0) -> int:
    value = xxhash.xxh3_64_intdigest(data, seed=seed)
    return value - (1 << 64) if value >> 63 else value


def sampled(rows: DataFrame, s: Settings) -> DataFrame:
    """A row for each run of ``(_row, bytes)``: ``inner`` ranks its owner, ``outer`` all of it."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in few(whole)):
            texts = batch.column("bytes").to_pylist()
            text, lo, hi, pos = owned_runs(texts, s)
            inner, outer = [], []
            for i, a, b, p in zip(text.tolist(), lo.tolist(), hi.tolist(), pos.tolist(), strict=True):
                data = texts[i]
                inner.append(_hash(data[p : p + s.sample]))
                outer.append(_hash(data[a : b + s.length], p - a))
            found = {"_row": batch.column("_row").to_numpy()[text], "lo": lo, "hi": hi, "pos": pos, "inner": inner, "outer": outer}
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found.values()], list(found))

    return rows.mapInArrow(run, "_row long, lo long, hi long, pos long, inner long, outer long")


def squeezed(rows: DataFrame) -> DataFrame:
    """``(_row, packed)``: the bytes compressed, as they are about to be shuffled."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in (part for whole in batches for part in few(whole)):
            packed = pa.array([pack(b) for b in batch.column("bytes").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), packed], ["_row", "packed"])

    return rows.mapInArrow(run, "_row long, packed binary")


def _contexts(rows: DataFrame, kinds: DataFrame, s: Settings) -> DataFrame:
    """The bytes of each kind's first run."""
    names = ("inner", "outer", "c", "_row", "lo", "hi", "pos")
    columns = [*names, "data"]

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for packed, *runs in batch.itertuples(index=False):
                data = unpack(packed)
                for found in zip(*(r.tolist() for r in runs), strict=True):
                    lo, hi = found[4], found[5]
                    out.append((*found, data[lo : hi + s.length]))
                    if len(out) >= AT_ONCE:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            yield pd.DataFrame(out, columns=columns)

    # Lists of numbers, one for each field: they stay flat in memory on their way to Python.
    per_row = kinds.groupBy("_row").agg(F.collect_list(F.struct(*names)).alias("runs"))
    per_row = per_row.select("_row", *[F.col(f"runs.{n}").alias(f"all_{n}") for n in names])
    schema = ", ".join(f"{n} long" for n in names) + ", data binary"
    joined = squeezed(rows).join(per_row, "_row").select("packed", *[f"all_{n}" for n in names])
    return joined.mapInPandas(run, schema)


def _pieces(contexts: DataFrame, s: Settings) -> DataFrame:
    """The pieces of each run, counted from its owner: ``whole`` ranks all their bytes,
    ``core`` the bytes that all windows of a full piece have."""
    columns = ["inner", "k", "whole", "core", "single", "outer", "_row", "lo", "hi"]

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                inner, outer, c, row, lo, hi, pos, data = r
                for k in range((pos - hi) // s.piece, (pos - lo) // s.piece + 1):
                    newest = pos - k * s.piece  # the last window of a full piece
                    a, b = max(lo, newest - s.piece + 1), min(hi, newest)
                    whole = _hash(data[a - lo : b - lo + s.length], pos - a)
                    core = _hash(data[newest - lo : newest - s.piece + 1 + s.length - lo])
                    out.append((inner, k, whole, core, c == 1, outer, row, a, b))
                if len(out) >= AT_ONCE:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    return contexts.mapInPandas(
        run,
        "inner long, k int, whole long, core long, single boolean, outer long, _row long, lo long, hi long",
    )


def _windows(contexts: DataFrame, pieces: DataFrame, s: Settings) -> DataFrame:
    """Single windows of the pieces, ranked."""
    columns = ["inner", "offset", "value", "open", "_row", "lo"]

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                for a, b, is_open in zip(r.los.tolist(), r.his.tolist(), r.opens.tolist(), strict=True):
                    for at in range(a, b + 1):
                        value = _hash(r.data[at - r.lo : at - r.lo + s.length])
                        out.append((r.inner, r.pos - at, value, bool(is_open), r.row, at))
                if len(out) >= AT_ONCE:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    grouped = pieces.groupBy("inner", "outer").agg(
        F.collect_list(F.struct("lo", "hi", F.col("open").cast("long").alias("open"))).alias("parts")
    )
    lists = [F.col(f"parts.{n}").alias(f"{n}s") for n in ("lo", "hi", "open")]
    joined = contexts.join(grouped, ["inner", "outer"])
    return joined.select("inner", F.col("_row").alias("row"), "lo", "pos", "data", *lists).mapInPandas(
        run, "inner long, offset long, value long, open boolean, _row long, lo long"
    )


def repeated_runs(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``(_row, lo, hi)``: windows that are repeated, as ranges of first bytes."""
    runs = sampled(rows, s)
    ranks = runs.groupBy("inner").agg(
        F.count(F.lit(1)).alias("n"), F.min("outer").alias("a"), F.max("outer").alias("b")
    )
    # Counts are stored before they are joined: Spark can then split the tasks of a frequent key.
    again = ranks.where("n > 1").select("inner", (F.col("a") != F.col("b")).alias("mixed"))
    again = stored(again, "again")
    runs = stored(runs.join(again, "inner"), "runs")
    repeated = [runs.where("NOT mixed").select("_row", "lo", "hi")]

    mixed = runs.where("mixed")
    kinds = stored(
        mixed.groupBy("inner", "outer")
        .agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("_row", "lo", "hi", "pos")).alias("run"))
        .select("inner", "outer", "c", "run.*"),
        "kinds",
    )
    several = kinds.where("c > 1").select("inner", "outer")
    repeated.append(mixed.join(several, ["inner", "outer"]).select("_row", "lo", "hi"))

    contexts = stored(_contexts(rows, kinds, s), "contexts")
    pieces = stored(_pieces(contexts, s), "pieces")
    of = ["inner", "k", "whole"]
    wholes = pieces.groupBy(*of).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("core", "single", "outer", "lo", "hi")).alias("piece"),
    )
    wholes = stored(wholes.select(*of, "n", "piece.*"), "wholes")
    twice = wholes.where("n > 1").select(*of)
    repeated.append(pieces.where("single").join(twice, of).select("_row", "lo", "hi"))

    # A kind found often is settled, but others may share a part of it.
    wholes = wholes.withColumn("open", (F.col("n") == 1) & F.col("single"))
    shared = wholes.groupBy("inner", "k", "core").agg(
        F.count(F.lit(1)).alias("kinds"), F.max("open").alias("any_open")
    )
    shared = stored(shared.where("kinds > 1 AND any_open").select("inner", "k", "core"), "shared")
    left = wholes.join(shared, ["inner", "k", "core"]).select("inner", "outer", "lo", "hi", "open")
    windows = stored(_windows(contexts, left, s), "windows")
    key = ["inner", "offset", "value"]
    double = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    double = stored(double, "double")
    single = windows.where("open").join(double, key).select("_row", "lo", F.col("lo").alias("hi"))
    repeated.append(single)
    return repeated[0].unionByName(repeated[1]).unionByName(repeated[2]).unionByName(repeated[3])


def spans(lo: np.ndarray, hi: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of ``[lo, hi + length)`` as ranges that do not touch."""
    order = np.argsort(lo, kind="stable")
    out: list[list[int]] = []
    for a, b in zip(lo[order].tolist(), (hi[order] + length).tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def cut(rows: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """``(_row, n_removed, n_spans, kept)`` for the texts that lose something."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for row, packed, lo, hi in zip(batch["_row"], batch["packed"], batch["lo"], batch["hi"], strict=True):
                data = unpack(packed)
                gone = spans(np.asarray(lo), np.asarray(hi), s.length)
                edges = [0, *[e for x in gone for e in x], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                starts, ends = zip(*gone, strict=True)
                out.append((row, len(data) - len(kept), starts, ends, hashlib.sha256(kept).hexdigest()))
                del data, kept
            yield pd.DataFrame(out, columns=["_row", "n_removed", "starts", "ends", "kept_sha256"])

    per_row = found.groupBy("_row").agg(
        F.collect_list(F.struct("lo", "hi")).alias("runs")
    ).select("_row", F.col("runs.lo").alias("lo"), F.col("runs.hi").alias("hi"))
    return squeezed(rows).join(per_row, "_row").mapInPandas(
        run,
        "_row long, n_removed long, starts array<long>, ends array<long>, kept_sha256 string",
    )


def byte_rows(documents: DataFrame, text: str = "text") -> DataFrame:
    return documents.select("_row", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("bytes"))


def remove_repeats(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of (doc_id, text).

    Null and empty texts, and those shorter than the length, lose nothing. Repeated rows
    are copies of each other. Ids are only passed through; other columns are ignored; an
    empty table gives no rows.
    """
    rows = numbered(documents.select("doc_id", "text"))
    data = byte_rows(rows)
    less = stored(cut(data, repeated_runs(data, s), s), "cut")
    less = less.select("_row", "n_removed", F.size("starts").alias("n_spans"), "kept_sha256")
    text = F.coalesce("text", F.lit(""))
    whole = rows.select(
        "_row",
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("sha256"),
    )
    return whole.join(less, "_row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.col("n_spans").cast("long"), F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def whole_characters(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    """``data`` without the ranges, of which characters that are cut in part stay whole."""
    edges = [0]
    for a, b in gone:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        edges += [a, b]
    edges.append(len(data))
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_repeats(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """All rows and columns, with the repeated strings cut out of ``text``.

    A character of which not all bytes are repeated stays. ``n_chars``, if there is such a
    column, follows the text. No row is dropped, not even one that is left without text.
    """
    row = free_name(documents, "_row")
    rows = numbered(documents, row)
    data = byte_rows(rows.select(F.col(row).alias("_row"), "text"))
    gone = stored(cut(data, repeated_runs(data, s), s), "cut")
    starts, ends = free_name(documents, "_starts"), free_name(documents, "_ends")
    gone = gone.select(F.col("_row").alias(row), F.col("starts").alias(starts), F.col("ends").alias(ends))
    columns, schema = documents.columns, documents.schema
    at = columns.index("text")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in few(whole)):
            arrays = batch.select(columns).columns
            texts = arrays[at].to_pylist()
            cuts = zip(batch.column(starts).to_pylist(), batch.column(ends).to_pylist(), strict=True)
            for i, (a, b) in enumerate(cuts):
                if a is not None:
                    texts[i] = whole_characters(texts[i].encode(), list(zip(a, b, strict=True))).decode()
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    cleaned = rows.join(gone, row, "left").drop(row).mapInArrow(run, schema)
    if "n_chars" in columns:
        kind = schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(kind))
    return cleaned.select(columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
