"""Toxicity: bags of subword embeddings averaged into a linear softmax.

A text is cut into windows of a few words. The bag of a window holds the character
n-grams of its words, with word marks; its embedding is their average, and a linear
softmax gives the chance that the window is toxic. A text is as toxic as its worst
window, because one insult does not weigh less in a long text. Embeddings and softmax
are trained jointly, in numpy. Words never seen, misspelled ones among them, share
n-grams with seen ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import few, giving_back, id_as_long, id_as_text, let_go, table, texts_of
from tierflow.llm.words import mix

WORD = re.compile(r"\w+")
_CACHED_WORDS = 150_000
# Words, and rows of the embeddings, that training works on at a time; they bound its work space.
_TRAINED_WORDS = 5_000
_TRAINED_ROWS = 16_384


@dataclass(frozen=True)
class Settings:
    """``train_rows``: labelled texts of each class used for training, whole, the first by id hash."""

    train_rows: int = 4000
    buckets: int = 1 << 18
    dims: int = 8
    shortest: int = 3
    longest: int = 6
    window: int = 2
    warm_epochs: int = 8
    epochs: int = 32
    rate: float = 0.1
    decay: float = 1e-3
    seed: int = 7


def subwords(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' n-grams, and the word of each."""
    text = "".join(f"<{w}>" for w in words)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    ids, owners = [], []
    value = np.zeros(len(chars), np.uint64)
    for n in range(1, s.longest + 1):
        usable = len(chars) - n + 1
        if usable <= 0:
            break
        value = value[:usable] * np.uint64(0x100000001B3) + chars[n - 1 :]
        if n < s.shortest:
            continue
        inside = np.arange(usable) + n <= ends[:usable]
        ids.append((mix(value[inside] + np.uint64(n)) % np.uint64(s.buckets)).astype(np.int64))
        owners.append(owner[:usable][inside])
    if not ids:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(ids), np.concatenate(owners)


@dataclass
class Model:
    """``weight``: what each bucket adds to the logit, its embedding times the softmax."""

    settings: Settings
    weight: np.ndarray
    bias: float
    prior: float

    def __post_init__(self):
        self._cache: dict[str, float] = {}
        self._older: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}, "_older": {}}

    def word_logits(self, words: list[str]) -> list[float]:
        """Mean weight of each word's subwords; a word shorter than the shortest has none: 0."""
        if len(self._cache) > _CACHED_WORDS:  # words not used since the last time go
            self._cache, self._older = {}, self._cache
        cache, older = self._cache, self._older
        new = []
        for w in dict.fromkeys(words):
            if w not in cache:
                if w in older:
                    cache[w] = older[w]
                else:
                    new.append(w)
        if new:
            ids, owner = subwords(new, self.settings)
            n = np.maximum(np.bincount(owner, minlength=len(new)), 1)
            mean = np.bincount(owner, self.weight[ids], len(new)) / n
            cache.update(zip(new, mean.tolist(), strict=True))
        return [cache[w] for w in words]

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        for i, text in enumerate(texts):
            words = WORD.findall(text.lower())
            if words:
                logits = np.array(self.word_logits(words))
                out[i] = 1 / (1 + np.exp(-np.clip(worst(logits, self.settings.window) + self.bias, -30, 30)))
        return out


def worst(logits: np.ndarray, window: int) -> float:
    """The highest mean over windows that overlap by half; a short text is one window."""
    step = max(window // 2, 1)
    total = np.concatenate([[0.0], np.cumsum(logits)])
    starts = np.arange(0, max(len(logits) - window, 0) + step, step)
    starts = np.minimum(starts, max(len(logits) - window, 0))
    ends = np.minimum(starts + window, len(logits))
    return float(((total[ends] - total[starts]) / (ends - starts)).max())


def train(texts: list[str], labels: list[int], prior: float, s: Settings) -> Model:
    """Full-batch Adam on each text's worst window, as the model sees it at that time.

    In the first epochs, when the model knows nothing yet, the worst window is the one
    whose words tell the classes apart best by the number of texts that have them. Without texts of both classes there is nothing to learn: all score the prior.
    """
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(s, np.zeros(s.buckets), float(np.log(prior / (1 - prior))), prior)
    vocabulary: dict[str, int] = {}
    number = vocabulary.setdefault
    ids = [
        np.array([number(w, len(vocabulary)) for w in WORD.findall(t.lower())], np.int32)
        for t in texts
    ]
    y, ids = y[[len(i) > 0 for i in ids]], [i for i in ids if len(i)]
    words = list(vocabulary)
    n_words = len(words)
    parts, counts = [], []
    for k in range(0, n_words, _TRAINED_WORDS):
        ids_, of = subwords(words[k : k + _TRAINED_WORDS], s)
        parts.append(ids_[np.argsort(of, kind="stable")].astype(np.int32))
        counts.append(np.bincount(of, minlength=min(_TRAINED_WORDS, n_words - k)))
    del vocabulary, words
    grams, counts = np.concatenate(parts), np.concatenate(counts)
    del parts
    n_grams = np.maximum(counts, 1)
    begins = np.concatenate([[0], np.cumsum(counts)])

    rng = np.random.default_rng(s.seed)
    params = [
        rng.normal(0, 0.1, (s.buckets, s.dims)),
        rng.normal(0, 0.5, (s.dims, 2)),
        np.zeros(2),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    clue = _contrast(ids, y, n_words)
    for epoch in range(s.warm_epochs + s.epochs):
        table_, softmax, bias = params
        if epoch >= s.warm_epochs:
            delta = table_ @ (softmax[:, 1] - softmax[:, 0])
            clue = _sums_by_word(delta, grams, counts, begins) / n_grams
        spans = [_worst_span(clue[i], s.window) for i in ids]
        word = np.concatenate([i[a:b] for i, (a, b) in zip(ids, spans, strict=True)])
        bag = np.repeat(np.arange(len(ids)), [b - a for a, b in spans])
        size = np.bincount(bag, minlength=len(ids))
        # words once each, their averaged embeddings, then the bags
        used, where = np.unique(word, return_inverse=True)
        take = np.concatenate([np.arange(begins[w], begins[w + 1]) for w in used])
        of = np.repeat(np.arange(len(used)), begins[used + 1] - begins[used])
        vector = np.stack(
            [np.bincount(of, table_[grams[take], d], len(used)) for d in range(s.dims)], 1
        ) / n_grams[used, None]
        mean = np.stack(
            [np.bincount(bag, vector[where, d], len(ids)) for d in range(s.dims)], 1
        ) / size[:, None]
        z = mean @ softmax + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - np.stack([1 - y, y], 1)) / len(y)
        d_mean = (error @ softmax.T) / size[:, None]
        d_vector = np.stack(
            [np.bincount(where, d_mean[bag, d], len(used)) for d in range(s.dims)], 1
        ) / n_grams[used, None]
        d_table = np.empty((s.buckets, s.dims))
        for d in range(s.dims):
            d_table[:, d] = np.bincount(grams[take], d_vector[of, d], s.buckets)
        for k, g in enumerate((d_table, mean.T @ error, error.sum(0))):
            for at in range(0, len(g), _TRAINED_ROWS):  # in place, a few rows at a time
                part = slice(at, at + _TRAINED_ROWS)
                slope, value, f, v = g[part], params[k][part], first[k][part], second[k][part]
                if k == 0:
                    slope = slope + s.decay * value / len(y)
                f *= 0.9
                f += 0.1 * slope
                v *= 0.99
                v += 0.01 * slope * slope
                value -= s.rate * (f / (1 - 0.9 ** (epoch + 1))) / (np.sqrt(v / (1 - 0.99 ** (epoch + 1))) + 1e-8)
    table_, softmax, bias = params
    delta = softmax[:, 1] - softmax[:, 0]
    return Model(s, table_ @ delta, float(bias[1] - bias[0]), prior)


def _sums_by_word(delta: np.ndarray, grams: np.ndarray, counts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The sum of ``delta`` over each word's n-grams, some words at a time."""
    out = np.zeros(len(counts))
    for k in range(0, len(counts), _TRAINED_WORDS):
        n = counts[k : k + _TRAINED_WORDS]
        mine = grams[begins[k] : begins[k + len(n)]]
        out[k : k + len(n)] = np.bincount(np.repeat(np.arange(len(n)), n), delta[mine], len(n))
    return out


def _contrast(ids: list[np.ndarray], y: np.ndarray, n_words: int) -> np.ndarray:
    """For each word the log ratio of its text shares in the two classes, smoothed."""
    found = [np.zeros(n_words), np.zeros(n_words)]
    for words, label in zip(ids, y, strict=True):
        found[int(label)][np.unique(words)] += 1
    share = [(f + 1) / (n + 2) for f, n in zip(found, ((y == 0).sum(), y.sum()), strict=True)]
    return np.log(share[1] / share[0])


def _worst_span(logits: np.ndarray, window: int) -> tuple[int, int]:
    total = np.concatenate([[0.0], np.cumsum(logits)])
    starts = np.arange(max(len(logits) - window, 0) + 1)
    ends = np.minimum(starts + window, len(logits))
    at = int(np.argmax((total[ends] - total[starts]) / (ends - starts)))
    return int(starts[at]), int(ends[at])


def remainder(id_col: str, modulus: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def fit(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Learns from labelled rows whose id's crc32 is not divisible by five.

    The sample is picked from the label table alone, ``train_rows`` of each class, so
    only that many texts are ever read out. Rows without id or label are not used; an
    id with several labels counts as toxic if one says so, of several texts the one of the
    smallest hash. One task trains on the sample,
    so that the driver holds no more than the finished weights.
    """
    seen = labels.select(F.col("doc_id"), F.col("toxic")).dropna()
    seen = seen.where(remainder("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rates = seen.agg(F.count(F.lit(1)), F.sum(F.col("toxic").cast("long"))).first()
    prior = (float(rates[1] or 0) + 0.5) / (rates[0] + 1.0)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    clean, toxic = (
        seen.where(F.col("toxic") == value).orderBy(*order).limit(s.train_rows) for value in (0, 1)
    )
    # At most two times train_rows, and they stay a query: no picked rows pass through the driver.
    ids = clean.unionByName(toxic).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(ids), "doc_id")  # at most two times train_rows ids
        .groupBy("doc_id", "toxic")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )
    prior = min(prior, 0.49)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        let_go()  # training takes the most memory of all tasks
        rows = rows.sort_values("doc_id")
        model = train(rows["text"].tolist(), rows["toxic"].tolist(), prior, s)
        return pd.DataFrame({"weight": [model.weight.astype("<f4").tobytes()], "bias": [model.bias]})

    one = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, "weight binary, bias double").first()
    if one is None:
        return train([], [], prior, s)
    return Model(s, np.frombuffer(one["weight"], "<f4").astype(float), one["bias"], prior)


def score(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` for each row; a text without words scores the prior."""
    rows = documents.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # buckets x 8 bytes

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns="text")
            out["score"] = shared.value.scores(batch["text"].tolist())
            yield out

    schema = rows.drop("text").schema.add("score", "double")
    return rows.mapInPandas(run, schema)


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores below one half."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in few(batch):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(shared.value.scores(texts) < 0.5))

    return documents.mapInArrow(run, documents.schema)


def toxicity(documents: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Null and empty texts score the training prior, below one half. Repeated rows score
    alike. A null id is never held out. Other columns are ignored, whatever their names.
    """
    model = fit(documents, labels, s)
    scored = id_as_long(score(id_as_text(texts_of(documents), "doc_id"), model, ["doc_id"]), "doc_id")
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
