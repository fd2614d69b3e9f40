"""Near duplicates by ProbMinHash over weighted word shingles.

Each shingle of a text sends arrivals of a Poisson process with its weight as the rate to
random registers; a register keeps its first arrival. Two texts agree in a register with
the chance of their probability Jaccard similarity. Shingles whose next arrival comes
later than all registers' first ones stop early. Bands of registers give the candidates,
and each link is verified on the shingles themselves. A text that repeats itself is signed
twice, with its counts and as a plain set, because a link may hold by either one alone.

Texts with the same weighted shingles are one class and compared once. In each bucket all
are first compared with one centre, the text that meets most others over all buckets, as
the original of many copies does: a large group of copies costs one comparison for each.
Only buckets that still hold different components go on. Their texts meet in tasks of
bounded size, which compare registers first and shingles where those agree, and pass on
the links they find, never pairs. So no link that the bands find is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.components import components
from tierflow.llm.suffix_dedup import byte_rows, squeezed
from tierflow.llm.tables import (
    free_name, giving_back, id_as_long, id_as_text, numbered, scan, stored, table, texts_of,
)
from tierflow.llm.words import mix, shingle_hashes, word_hashes

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``bands`` of ``rows`` registers; 32 of 5 miss a pair at 0.8 three times in a million.
    ``agreement``: share of all registers that candidates have in common at least; a pair
    at 0.8 has less than 0.65 of 160 once in a million times. Both hold for similarity by
    weights and as plain sets, each by its own registers. ``chunk``: texts of a
    bucket that meet in one task, on each side. ``weights``: a shingle's weight is its ``count`` in the text, or 1 by ``presence``."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 32
    rows: int = 5
    agreement: float = 0.65
    weights: str = "count"
    batch_bytes: int = 1 << 20
    chunk: int = 2048


def weighted_shingles(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and weights of all texts' distinct shingles in order, and where each text's begin.

    Words are runs between white space, A-Z lower-cased. A text of fewer words than a
    shingle has one shingle of them; one without words has none.
    """
    words, offsets = word_hashes([t.encode("utf-8", "surrogatepass") for t in texts])
    value, text = shingle_hashes(words, offsets, s.shingle)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(value))).astype(float)
    if s.weights == "presence":
        weight = np.ones(len(at))
    return value[at], weight, np.searchsorted(text[at], np.arange(len(texts) + 1))


def signatures(value: np.ndarray, weight: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """The shingle that arrived first in each of ``m`` registers, a row for each text."""
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    time = np.full(n * m, np.inf)
    first = np.zeros(n * m, _U)
    alive = np.arange(len(value))
    now = np.zeros(len(value))
    step = 0
    while len(alive):
        step += 1
        draw = mix(value[alive] + _U(step * 0xD1342543DE82EF95 % (1 << 64)))
        now = now - np.log(((draw >> _U(11)).astype(float) + 0.5) / 2**53) / weight[alive]
        register = (mix(draw + _U(1)) % _U(m)).astype(np.int64) + text[alive] * m
        np.minimum.at(time, register, now)
        won = time[register] == now
        first[register[won]] = value[alive[won]]
        go_on = now < time.reshape(n, m).max(1)[text[alive]]
        alive, now = alive[go_on], now[go_on]
    return first.reshape(n, m)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two sorted shingle lists with weights: the sum over common
    shingles d of 1 / sum over all e of max(a_e / a_d, b_e / b_d). With equal weights
    within each text this is the Jaccard similarity of the two sets, up to their sizes."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    u, v = a[1][i], b[1][j]
    # Shingles ordered by a_e / b_e: those above d's ratio count with a, the others with b.
    ratio = u / v
    order = np.argsort(ratio, kind="stable")
    only_a, only_b = a[1].sum() - u.sum(), b[1].sum() - v.sum()
    su = np.concatenate([[0.0], np.cumsum(u[order])])
    sv = np.concatenate([[0.0], np.cumsum(v[order])])
    upto = np.searchsorted(ratio[order], ratio, "right")
    above = su[-1] - su[upto] + only_a
    below = sv[upto] + only_b
    return float((1 / (above / u + below / v)).sum())


def alike(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], s: Settings) -> bool:
    """Whether two lists are similar enough, by weights or as plain sets of shingles.

    The two differ where a text repeats itself. Both are asked, so that neither a repeated
    line nor its missing repeats hide a near copy.
    """
    if probability_jaccard(a, b) >= s.similarity - 1e-12:
        return True
    common = len(np.intersect1d(a[0], b[0], assume_unique=True))
    return common >= (s.similarity - 1e-12) * (len(a[0]) + len(b[0]) - common)


def both_signatures(
    value: np.ndarray, weight: np.ndarray, offsets: np.ndarray, m: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures by weights and as plain sets, and which texts have weights that differ from
    one; the two are the same for all others."""
    counted = signatures(value, weight, offsets, m)
    uneven = np.concatenate([[0], np.cumsum(weight != 1)])
    repeats = uneven[offsets[1:]] > uneven[offsets[:-1]]
    plain = counted.copy()
    if repeats.any():
        sizes = np.diff(offsets)
        own = value[np.repeat(repeats, sizes)]
        at = np.concatenate([[0], np.cumsum(sizes[repeats])])
        plain[repeats] = signatures(own, np.ones(len(own)), at, m)
    return counted, plain, repeats


def _band_keys(found: np.ndarray, s: Settings) -> np.ndarray:
    key = np.zeros((len(found), s.bands), _U)
    for k in range(s.rows):
        key = mix(key * _U(3) + found[:, k :: s.rows] + _U(k))
    return mix(key + np.arange(s.bands, dtype=_U))


def _twice(x: np.ndarray | bytes, size: int) -> np.ndarray | bytes:
    """Bands or sketch by counts and as a plain set; stored once where the two are the same."""
    if len(x) == 2 * size:
        return x
    return x * 2 if isinstance(x, bytes) else np.concatenate([x, x])


def _sketches(column: Iterable[bytes], s: Settings) -> np.ndarray:
    """A row for each text: its registers' bytes by counts and as a plain set."""
    m = s.bands * s.rows
    return np.frombuffer(b"".join(_twice(x, m) for x in column), np.uint8).reshape(-1, 2, m)


def _agree(a: np.ndarray, b: np.ndarray, s: Settings) -> np.ndarray:
    """Whether sketches agree often enough by counts or as plain sets."""
    return (np.count_nonzero(a == b, -1) >= s.agreement * a.shape[-1]).any(-1)


def _long(x: np.ndarray) -> np.ndarray:
    return x.astype(_U).view(np.int64)


def _slices(texts: list[str], size: int) -> Iterator[slice]:
    """Runs of texts of about ``size`` characters together."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield slice(at, i + 1)
            at, held = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def sign(rows: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``(_row, doc_id, hi, lo, bands, sketch)``: a digest of the weighted shingles, the band
    hashes, and a byte of each register; null where a text has no words. A text that repeats
    shingles has the bands and registers of its plain set behind those of its counts."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for part in _slices(texts, s.batch_bytes):
                value, weight, at = weighted_shingles(texts[part], s)
                counted, plain, repeats = both_signatures(value, weight, at, s.bands * s.rows)
                keys = np.concatenate([_band_keys(counted, s), _band_keys(plain, s)], 1)
                low = np.concatenate([counted, plain], 1).astype(np.uint8)
                digests, bands, sketches = [], [], []
                for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                    if a == b:
                        digests.append((None, None))
                        bands.append(None)
                        sketches.append(None)
                        continue
                    digest = xxhash.xxh3_128(value[a:b].tobytes() + weight[a:b].tobytes()).digest()
                    digests.append(tuple(np.frombuffer(digest, np.int64).tolist()))
                    both = 2 if repeats[i] else 1
                    bands.append(_long(keys[i, : both * s.bands]))
                    sketches.append(low[i, : both * s.bands * s.rows].tobytes())
                out = batch.iloc[part][["_row", "doc_id"]].reset_index(drop=True)
                out["hi"] = pd.array([d[0] for d in digests], "Int64")
                out["lo"] = pd.array([d[1] for d in digests], "Int64")
                out["bands"] = bands
                out["sketch"] = sketches
                yield out

    out = id_as_text(rows, "doc_id").mapInPandas(
        run, "_row long, doc_id string, hi long, lo long, bands array<long>, sketch binary"
    )
    return id_as_long(out, "doc_id")


def shingles(rows: DataFrame, s: Settings) -> DataFrame:
    """``(class, shingles)`` of ``(_row, packed)``: sorted hashes as bytes, and weights if they
    are not all one."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(0, len(batch), 512):
                some = batch.iloc[k : k + 512]
                texts = [unpack(p).decode() for p in some["packed"]]
                for part in _slices(texts, s.batch_bytes):
                    value, weight, at = weighted_shingles(texts[part], s)
                    packed = [
                        _packed(value[a:b], weight[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)
                    ]
                    yield pd.DataFrame({"class": some["_row"].iloc[part].to_numpy(), "shingles": packed})

    return rows.select("_row", "packed").mapInPandas(run, "class long, shingles binary")


def _packed(value: np.ndarray, weight: np.ndarray) -> bytes:
    plain = bool((weight == 1).all())
    return bytes([plain]) + value.tobytes() + (b"" if plain else weight.tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    plain, data = data[0], data[1:]
    if plain:
        return np.frombuffer(data, _U), np.ones(len(data) // 8)
    half = len(data) // 2
    return np.frombuffer(data[:half], _U), np.frombuffer(data[half:])


def verify(pairs: DataFrame, lists: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``(centre, class)`` that are as similar as asked for."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [
                alike(_unpacked(a), _unpacked(b), s)
                for a, b in zip(batch["theirs"], batch["shingles"], strict=True)
            ]
            yield batch.loc[keep, ["centre", "class"]]

    # Only the lists that these pairs name are shuffled.
    ours = lists.join(pairs.select("class").distinct(), "class", "left_semi")
    theirs = lists.select(F.col("class").alias("centre"), F.col("shingles").alias("theirs"))
    theirs = theirs.join(pairs.select("centre").distinct(), "centre", "left_semi")
    joined = pairs.join(ours, "class").join(theirs, "centre")
    return joined.select("centre", "class", "theirs", "shingles").mapInPandas(run, "centre long, class long")


def agreeing(pairs: DataFrame, sketches: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose registers agree often enough to be worth reading their shingles."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = _agree(_sketches(batch["theirs"], s), _sketches(batch["sketch"], s), s)
                yield batch.loc[near, ["centre", "class"]]

    theirs = sketches.select(F.col("class").alias("centre"), F.col("sketch").alias("theirs"))
    joined = pairs.join(sketches, "class").join(theirs, "centre")
    return joined.select("centre", "class", "theirs", "sketch").mapInPandas(run, "centre long, class long")


def _centred(buckets: DataFrame) -> DataFrame:
    """Pairs of each bucket's centre with its other classes."""
    centre = buckets.groupBy("bucket").agg(F.max(F.struct("degree", -F.col("class"))).alias("c"))
    centre = stored(centre.select("bucket", (-F.col("c")["col2"]).alias("centre")), "centres")
    pairs = buckets.join(centre, "bucket").where(F.col("class") != F.col("centre"))
    return pairs.select("centre", "class").distinct()


def _meetings(rows: DataFrame, s: Settings) -> DataFrame:
    """Each row once for every task of its bucket: chunks ``i`` and ``j`` meet in a task."""
    size = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / s.chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    k = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    return (
        rows.join(size, "bucket")
        .select("*", own.alias("own"))
        .select("*", k.alias("k"))
        .select("*", F.least("own", "k").alias("i"), F.greatest("own", "k").alias("j"))
        .drop("chunks", "k")
    )


def _by_task(batches: Iterator[pd.DataFrame], s: Settings) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each task's rows, from rows sorted by task."""
    held = None
    for batch in _with_end(batches):
        last = batch is None
        rows = held if last else batch if held is None else pd.concat([held, batch], ignore_index=True)
        if rows is None or rows.empty:
            continue
        columns = {c: rows[c].to_numpy() for c in rows.columns if c not in ("bands", "sketch")}
        bands = np.concatenate([_twice(b, s.bands) for b in rows["bands"]])
        columns["bands"] = bands.reshape(len(rows), 2, s.bands)
        columns["sketch"] = _sketches(rows["sketch"], s)
        new = np.zeros(len(rows), bool)
        new[0] = True
        for c in ("bucket", "i", "j"):
            new[1:] |= columns[c][1:] != columns[c][:-1]
        starts = np.flatnonzero(new)
        ends = [*starts[1:], len(rows)]
        for a, b in zip(starts if last else starts[:-1], ends, strict=False):
            if b - a > 1:
                yield {c: v[a:b] for c, v in columns.items()}
        held = None if last else rows.iloc[starts[-1] :]


def _with_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _near(task: dict[str, np.ndarray], s: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a task the later ones in other components whose registers agree, and
    for which this bucket's band is the first that they share."""
    i, j, own = task["i"][0], task["j"][0], task["own"]
    component, bands, sketch = task["component"], task["bands"], task["sketch"]
    if (component == component[0]).all():
        return
    band = int(np.nonzero(bands[0] == task["bucket"][0])[1][0])
    theirs = np.flatnonzero(own == j)
    for a in range(len(own)):
        if i != j and own[a] != i:
            continue
        others = np.arange(a + 1, len(own)) if i == j else theirs
        others = others[component[others] != component[a]]
        if len(others):
            others = others[_agree(sketch[others], sketch[a], s)]
        if len(others):
            # A text's counts may meet another's plain set: they share the band all the same.
            shared = (bands[others] == bands[a]).any(1) | (bands[others] == bands[a, ::-1]).any(1)
            others = others[shared.argmax(1) == band]
        if len(others):
            yield a, others


def _worth_reading(rows: DataFrame, s: Settings) -> DataFrame:
    """The ``(bucket, class)`` rows that have somebody near in their bucket."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in _by_task(batches, s):
            found = np.zeros(len(task["class"]), bool)
            for a, others in _near(task, s):
                found[a] = True
                found[others] = True
            if found.any():
                yield pd.DataFrame({c: task[c][found] for c in ("bucket", "class")})

    tasks = _meetings(rows, s).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return tasks.mapInPandas(run, "bucket long, class long").distinct()


def _links_within(rows: DataFrame, s: Settings) -> DataFrame:
    """Links between components of a bucket, one for each two that a task finds connected."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in _by_task(batches, s):
            component, names = task["component"].tolist(), task["class"].tolist()
            root = {c: c for c in component}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            out = []
            for a, others in _near(task, s):
                for b in others.tolist():
                    x, y = find(component[a]), find(component[b])
                    if x == y:
                        continue
                    for k in (a, b):
                        if k not in lists:
                            lists[k] = _unpacked(task["shingles"][k])
                    if alike(lists[a], lists[b], s):
                        root[x] = y
                        out.append((names[a], names[b]))
            if out:
                yield pd.DataFrame(out, columns=["centre", "class"])

    tasks = _meetings(rows, s).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return tasks.mapInPandas(run, "centre long, class long")


def _packed_texts(documents: DataFrame, involved: DataFrame) -> DataFrame:
    """``(_row, packed)`` of the classes' texts.

    Always dealt out, as it is where the classes are too many to be broadcast: two Python
    functions in one stage would have two workers for each core, which stay.
    """
    rows = involved.select(F.col("class").alias("_row"))
    return squeezed(byte_rows(documents)).join(rows.hint("merge"), "_row")


def linked_classes(documents: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """``(node, component)`` of all classes that have a link. ``reps``: ``(class, bands, sketch)``."""
    banded = reps.select("class", F.explode(F.array_distinct("bands")).alias("bucket"))
    several = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = stored(several, "several")  # so that Spark can split a frequent bucket's tasks
    found = stored(banded.join(several, "bucket"), "met")
    degrees = found.groupBy("class").agg(F.sum("n").alias("degree"))
    buckets = stored(found.join(degrees, "class").select("bucket", "class", "degree"), "buckets")
    # Stored, so that its size is known before any text or register would be shuffled to it.
    involved = stored(buckets.select("class").distinct(), "involved")
    sketches = stored(reps.join(involved, "class").select("class", "bands", "sketch"), "sketches")
    lists = stored(shingles(_packed_texts(documents, involved), s), "shingles")

    close = stored(agreeing(_centred(buckets), sketches.drop("bands"), s), "close")
    links = stored(verify(close, lists, s), "links")
    labels = stored(components(links, "centre", "class", passes=2), "labels")
    labelled = buckets.join(labels, F.col("class") == F.col("node"), "left").select(
        "bucket", "class", F.coalesce("component", "class").alias("component")
    )
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = stored(mixed.where("a <> b").select("bucket"), "mixed")
    left = stored(labelled.join(mixed, "bucket"), "open")
    worth = stored(_worth_reading(left.join(sketches, "class"), s), "worth")
    left = left.join(worth, ["bucket", "class"]).join(sketches, "class")
    needed = lists.join(worth.select("class").distinct(), "class", "left_semi")
    more = stored(_links_within(left.join(needed, "class"), s), "links")
    return components(links.unionByName(more), "centre", "class")


def near_duplicates(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``_row, doc_id, class_row, group_row, kept`` for every row of ``(_row, doc_id, text)``.

    Rows of one class have the same weighted shingles; rows of one group are connected by
    links. The group's first row, by row number, is kept. Texts without words (null and
    empty ones among them) are similar to nothing: each is its own group and kept.
    Repeated rows and ids are told apart by row. An empty table gives no rows.
    """
    signed = stored(sign(documents, s), "signed")
    worded = signed.where("bands IS NOT NULL")
    classes = stored(worded.groupBy("hi", "lo").agg(F.min("_row").alias("class")), "classes")
    reps = worded.join(classes.select(F.col("class").alias("_row")), "_row").select(
        F.col("_row").alias("class"), "bands", "sketch"
    )
    reps = stored(reps, "reps")
    groups = linked_classes(documents, reps, s)
    members = classes.join(groups, F.col("class") == F.col("node"), "left").select(
        "hi", "lo", "class", F.coalesce("component", "class").alias("group_row")
    )
    return (
        signed.drop("bands", "sketch")
        .join(members, ["hi", "lo"], "left")
        .select(
            "_row",
            "doc_id",
            F.coalesce("class", "_row").alias("class_row"),
            F.coalesce("group_row", "_row").alias("group_row"),
        )
        .withColumn("kept", F.col("_row") == F.col("group_row"))
    )


def without_copies(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """All columns of the rows that stay: one row of each group."""
    documents, row = scan(documents), free_name(documents, "_row")
    found = near_duplicates(texts_of(documents), s)
    gone = stored(found.where("NOT kept").select(F.col("_row").alias(row)), "copies")
    return numbered(documents, row).join(gone, row, "left_anti").drop(row)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, class_id, group_id, kept``: ids of the first rows of class and group."""
    documents = texts_of(table(spark, sf_dir, "documents"))
    found = near_duplicates(documents)
    firsts = documents.select(F.col("_row").alias("first"), F.col("doc_id").alias("first_id"))
    for kind in ("class", "group"):
        ids = firsts.select("first", F.col("first_id").alias(f"{kind}_id"))
        found = found.join(ids, F.col(f"{kind}_row") == F.col("first")).drop("first")
    return found.select("doc_id", "class_id", "group_id", "kept")
