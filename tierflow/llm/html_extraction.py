"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks. Each block becomes a vector of its tag path (tags, classes and
ids hashed into an embedding), of its words (hashed likewise), and a few numbers such as
length and share of links. A bidirectional LSTM, in numpy, reads the page's blocks in both
directions and labels every block knowing the whole page. It is trained on made-up layouts
with words of the given pages, so it does not rely on elements that name their content.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.page_blocks import Block, blocks_of
from tierflow.llm.page_layouts import Layouts
from tierflow.llm.tables import id_as_long, id_as_text, smallest, table

N_NUMBERS = 8


@dataclass(frozen=True)
class Settings:
    """``word_pages``: pages that lend their words to the made-up layouts; ``layouts``: pages
    trained on."""

    word_pages: int = 200
    layouts: int = 3000
    epochs: int = 10
    buckets: int = 1024
    embed: int = 12
    hidden: int = 20
    batch: int = 32
    rate: float = 0.01
    seed: int = 11
    batch_blocks: int = 20_000


class _Buckets(dict):
    """The bucket of each name met so far; names come again and again, in texts and in paths."""

    most = 200_000

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, name: str) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) % self.n
        return found

    @classmethod
    @functools.cache
    def of(cls, n: int) -> _Buckets:
        return cls(n)


def _counts(names: Iterable[str], n: int) -> np.ndarray:
    """Buckets of names and how many names fall into each: two rows, at most ``n`` columns."""
    found = Counter(map(_Buckets.of(n).__getitem__, names))
    return np.array([*found, *found.values()], np.int64).reshape(2, -1)


def _digits(text: str) -> int:
    if text.isascii():
        return sum(map(text.count, "0123456789"))
    return sum(map(str.isdigit, text))


def features(page: list[Block], s: Settings) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of each block: counted buckets of its path, counted buckets of all its words, and its
    numbers."""
    paths, words, numbers = [], [], []
    known: dict[tuple, np.ndarray] = {}
    for i, b in enumerate(page):
        if b.path not in known:
            names = dict.fromkeys([*b.path, f"last:{b.path[-1]}" if b.path else "none"])
            known[b.path] = _counts(names, s.buckets)
        paths.append(known[b.path])
        words.append(_counts(b.text.lower().split(), s.buckets))
        n = len(b.text)
        numbers.append(
            (
                n,
                b.linked / n,
                (b.text.count(".") + b.text.count(",")) * 20 / (n + 20),
                b.text[-1] in ".!?…:;\"'",
                _digits(b.text) / n,
                i / len(page),
                (len(page) - 1 - i) / len(page),
                min(b.depth, 12) / 12,
            )
        )
    numbers = np.array(numbers, float).reshape(len(page), N_NUMBERS)
    numbers[:, 0] = np.log1p(numbers[:, 0]) / 6
    return paths, words, numbers


@dataclass
class Labeller:
    """Weights of the embeddings, the two LSTMs and the output."""

    settings: Settings
    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, s: Settings) -> Labeller:
        rng = np.random.default_rng(s.seed)
        inputs, h = 2 * s.embed + N_NUMBERS, s.hidden
        w = {"path": rng.normal(0, 0.3, (s.buckets, s.embed)), "word": rng.normal(0, 0.3, (s.buckets, s.embed))}
        for d in ("f", "b"):
            w[f"{d}_x"] = rng.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * h))
            w[f"{d}_h"] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))
            w[f"{d}_0"] = np.repeat([0.0, 1.0, 0.0, 0.0], h)  # input, forget, output, new
        w["out"] = rng.normal(0, 0.3, 2 * h)
        w["out_0"] = np.zeros(1)
        return cls(s, w)

    def _lstm(self, d: str, x: np.ndarray, mask: np.ndarray):
        """States of all steps; ``x`` is (steps, pages, inputs). Padding keeps the state."""
        steps, pages, _ = x.shape
        n = self.settings.hidden
        gates_x = x @ self.weights[f"{d}_x"] + self.weights[f"{d}_0"]
        h, c = np.zeros((pages, n)), np.zeros((pages, n))
        kept = []
        out = np.zeros((steps, pages, n))
        for t in range(steps):
            g = gates_x[t] + h @ self.weights[f"{d}_h"]
            gate = 1 / (1 + np.exp(-np.clip(g[:, : 3 * n], -30, 30)))
            new = np.tanh(g[:, 3 * n :])
            c_next = gate[:, n : 2 * n] * c + gate[:, :n] * new
            tanh_c = np.tanh(c_next)
            h_next = gate[:, 2 * n :] * tanh_c
            m = mask[t][:, None]
            kept.append((h, c, gate, new, tanh_c))
            h, c = np.where(m, h_next, h), np.where(m, c_next, c)
            out[t] = h
        return out, kept

    def _lstm_back(self, d: str, x, mask, kept, d_out, grads):
        n = self.settings.hidden
        steps, pages, _ = x.shape
        d_h, d_c = np.zeros((pages, n)), np.zeros((pages, n))
        d_gates = np.zeros((steps, pages, 4 * n))
        for t in range(steps - 1, -1, -1):
            h, c, gate, new, tanh_c = kept[t]
            m = mask[t][:, None]
            d_h = d_h + d_out[t]
            d_next = np.where(m, d_h, 0)
            through_c = np.where(m, d_c, 0) + d_next * gate[:, 2 * n :] * (1 - tanh_c**2)
            i, f, o = gate[:, :n], gate[:, n : 2 * n], gate[:, 2 * n :]
            g = np.concatenate(
                [
                    through_c * new * i * (1 - i),
                    through_c * c * f * (1 - f),
                    d_next * tanh_c * o * (1 - o),
                    through_c * i * (1 - new**2),
                ],
                1,
            )
            d_gates[t] = g
            grads[f"{d}_h"] += h.T @ g
            d_h = np.where(m, g @ self.weights[f"{d}_h"].T, d_h)
            d_c = np.where(m, through_c * f, d_c)
        grads[f"{d}_x"] += np.tensordot(x, d_gates, ([0, 1], [0, 1]))
        grads[f"{d}_0"] += d_gates.sum((0, 1))
        return d_gates @ self.weights[f"{d}_x"].T

    def _inputs(self, pages: list[tuple]):
        """Padded inputs of pages, which steps are blocks, and what the gradient needs."""
        s, steps = self.settings, max(len(p[2]) for p in pages)
        x = np.zeros((steps, len(pages), 2 * s.embed + N_NUMBERS))
        mask = np.zeros((steps, len(pages)), bool)
        bags = []
        for k, name in enumerate(("path", "word")):
            lists = [b for p in pages for b in p[k]]
            lengths = np.array([b.shape[1] for b in lists])
            (ids, n), of = np.concatenate(lists, 1), np.repeat(np.arange(len(lists)), lengths)
            first = np.cumsum(lengths) - lengths
            share = n / np.add.reduceat(n, first)[of]
            mean = np.add.reduceat(self.weights[name][ids] * share[:, None], first, axis=0)
            bags.append((ids, of, share, mean))
        at = 0
        where_t = np.concatenate([np.arange(len(p[2])) for p in pages])
        where_p = np.repeat(np.arange(len(pages)), [len(p[2]) for p in pages])
        for _, _, _, mean in bags:
            x[where_t, where_p, at : at + s.embed] = mean
            at += s.embed
        x[where_t, where_p, at:] = np.concatenate([p[2] for p in pages])
        mask[where_t, where_p] = True
        return x, mask, bags, where_t, where_p

    def _logits(self, x, mask):
        ahead, kept_f = self._lstm("f", x, mask)
        behind, kept_b = self._lstm("b", x[::-1], mask[::-1])
        both = np.concatenate([ahead, behind[::-1]], 2)
        return both @ self.weights["out"] + self.weights["out_0"], both, kept_f, kept_b

    def label(self, pages: list[tuple]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][2]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        group: list[int] = []
        for i in [*order, None]:
            full = group and (i is None or (len(group) + 1) * len(pages[i][2]) > self.settings.batch_blocks)
            if full:
                x, mask, *_ = self._inputs([pages[k] for k in group])
                z = self._logits(x, mask)[0]
                for n, k in enumerate(group):
                    out[k] = z[: len(pages[k][2]), n] > 0
                group = []
            if i is not None and len(pages[i][2]):
                group.append(i)
        return out

    def step(self, pages: list[tuple], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over the pages' blocks."""
        x, mask, bags, where_t, where_p = self._inputs(pages)
        z, both, kept_f, kept_b = self._logits(x, mask)
        y = np.concatenate(labels)
        d_z = np.zeros_like(z)
        p = 1 / (1 + np.exp(-np.clip(z[where_t, where_p], -30, 30)))
        d_z[where_t, where_p] = (p - y) / len(y)
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        grads["out"] = np.tensordot(both, d_z, ([0, 1], [0, 1]))
        grads["out_0"] = d_z.sum(keepdims=True)[0]
        d_both = d_z[:, :, None] * self.weights["out"]
        n = self.settings.hidden
        d_x = self._lstm_back("f", x, mask, kept_f, d_both[:, :, :n], grads)
        d_x += self._lstm_back("b", x[::-1], mask[::-1], kept_b, d_both[::-1, :, n:], grads)[::-1]
        d_blocks = d_x[where_t, where_p]
        for k, name in enumerate(("path", "word")):
            ids, of, share, _ = bags[k]
            part = d_blocks[:, k * self.settings.embed : (k + 1) * self.settings.embed]
            np.add.at(grads[name], ids, part[of] * share[:, None])
        return grads

    def train(self, pages: list[tuple], labels: list[np.ndarray]) -> None:
        s = self.settings
        rng = np.random.default_rng(s.seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        t = 0
        for epoch in range(s.epochs):
            rate = s.rate * (0.3 if epoch >= s.epochs - 2 else 1)
            order = rng.permutation(len(pages))
            for a in range(0, len(order), s.batch):
                part = order[a : a + s.batch]
                t += 1
                grads = self.step([pages[i] for i in part], [labels[i] for i in part])
                norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 1.0 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    up = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * up


def made_pages(words: list[str], n: int, seed: int, s: Settings) -> tuple[list[tuple], list[np.ndarray]]:
    """Features and labels of made-up pages; one whose blocks are not read as meant is left out."""
    layouts = Layouts(words, seed)
    pages, labels = [], []
    for _ in range(n):
        page, want = layouts.page()
        blocks = blocks_of(page)
        if blocks and [" ".join(t.split()) for t, _ in want] == [b.text for b in blocks]:
            pages.append(features(blocks, s))
            labels.append(np.array([m for _, m in want], float))
    return pages, labels


def fit(pages: DataFrame, s: Settings = Settings()) -> Labeller:
    """Trained on layouts that use words of at most ``word_pages`` pages, picked by hash."""
    key = F.xxhash64("html")
    sample = (
        smallest(pages.where("html IS NOT NULL").select("html"), key, s.word_pages)
        .groupBy(key.alias("key"))
        .agg(F.min("html").alias("html"))
        .orderBy("key")
        .collect()
    )
    words = [w.strip(".,") for r in sample for b in blocks_of(r["html"]) for w in b.text.split()]
    found = Labeller.new(s)
    made, labels = made_pages(sorted(w for w in words if w), s.layouts, s.seed, s)
    found.train(made, labels)
    return found


def main_texts(htmls: list[str], model: Labeller) -> list[str]:
    pages = [blocks_of(h) for h in htmls]
    labels = model.label([features(p, model.settings) for p in pages])
    return ["\n".join(b.text for b, main in zip(p, l, strict=True) if main) for p, l in zip(pages, labels, strict=True)]


def extract(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``(page_id, url, html)``.

    Null and empty html, and pages without main text, give an empty text. Ids and urls
    are passed through, nulls too; repeated rows are extracted each; other columns are
    ignored; an empty table gives no rows.
    """
    model = pages.sparkSession.sparkContext.broadcast(fit(pages, s))  # its size is set by ``s``
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.iloc[a : a + 256]
                out = part[["page_id", "url"]].copy()
                out["text"] = main_texts(part["html"].tolist(), model.value)
                out["n_chars"] = out["text"].str.len()
                yield out

    rows = id_as_text(rows, "page_id")
    out = rows.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return id_as_long(out, "page_id")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
