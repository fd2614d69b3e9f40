"""URL filter: rules first, else words segmented out of the host and a naive Bayes on them.

Host labels are concatenated words ("cheappills"). A unigram model splits them by the
Viterbi path; the tokens of host and path are then scored by multinomial naive Bayes.
The word model comes from the ranks of a public vocabulary, the classes from the pages'
own distinct hosts, labelled by a short list of words that name unwanted trades.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import id_as_long, id_as_text, table

# Fixed values: (host, path, verdict) of the rules.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# Words that mark a host as unwanted when the model is trained.
UNWANTED = (
    "ads adult adverts bet bets betting bitcoin casino cheap clickbait dating erotic escort "
    "farm free gambling jackpot loan loans lottery malware nude payday pharmacy phishing pill "
    "pills poker porn replica sex slots spam spyware torrent track tracker tracking viagra warez "
    "win winner xxx"
).split()
# Unwanted only in company: common words that also name harmless sites.
WEAK = frozenset("cheap farm free track win winner".split())
_PART = re.compile(r"[^0-9a-z\u0080-\U0010ffff]+")
_RUN = re.compile(r"[0-9]+|[^0-9]+")


@dataclass(frozen=True)
class Words:
    """Unigram log probabilities; unknown letters cost ``unknown`` each."""

    logp: dict[str, float]
    longest: int
    unknown: float = -14.0

    @classmethod
    def from_vocabulary(cls, path: str, extra: tuple[str, ...] = ()) -> Words:
        """Whole lower-case words of a vocabulary file; weight falls with the rank (Zipf).

        ``extra`` words that the vocabulary lacks rank with its last ones.
        """
        ranks: dict[str, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                text = base64.b64decode(token).decode("utf-8", "ignore")
                word = text[1:].lower()
                if text[:1] == " " and word.isalpha() and (len(word) > 2 or int(rank) < 1000):
                    ranks.setdefault(word, int(rank))
        last = max(ranks.values(), default=1)
        for word in extra:
            ranks.setdefault(word, last)
        total = math.log(sum(1 / (r + 100) for r in ranks.values()))
        logp = {w: -math.log(r + 100) - total for w, r in ranks.items()}
        return cls(logp, max(map(len, logp), default=1))

    def split(self, run: str) -> list[str]:
        """The most probable words; neighbouring unknown letters form one word.

        Linear in the run's length: each end looks back ``longest`` letters at most.
        """
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            score, at = best[end - 1] + self.unknown, end - 1
            for start in range(max(0, end - self.longest), end):
                p = self.logp.get(run[start:end])
                if p is not None and best[start] + p > score:
                    score, at = best[start] + p, start
            best.append(score)
            back.append(at)
        words: list[str] = []
        end, unknown_end = len(run), -1
        while end:
            at = back[end]
            word = run[at:end]
            if word in self.logp:
                unknown_end = -1
                words.append(word)
            elif unknown_end >= 0:
                words[-1] = word + words[-1]
            else:
                unknown_end = end
                words.append(word)
            end = at
        return words[::-1]


@dataclass
class Bayes:
    """Multinomial naive Bayes; ``score`` > 0 means block.

    Both classes start from ``mass`` tokens of the word model, the unwanted one with half
    of them spread over the words that name unwanted trades, of which the weak ones get
    a twentieth. So counts of a small table do not outweigh what is known beforehand.
    """

    prior: float
    weight: dict[str, float]

    @classmethod
    def from_counts(
        cls, counts: dict[str, tuple[int, int]], hosts: tuple[int, int], words: Words, mass: float = 200.0
    ) -> Bayes:
        share = {w: 0.05 if w in WEAK else 1.0 for w in UNWANTED}
        named = sum(share.values())
        totals = [sum(c[k] for c in counts.values()) + mass for k in (0, 1)]
        weight = {}
        for w, logp in words.logp.items():
            good, bad = counts.get(w, (0, 0))
            usual = math.exp(logp)
            unwanted = (usual + share.get(w, 0.0) / named) / 2
            weight[w] = math.log((bad + mass * unwanted) / totals[1]) - math.log(
                (good + mass * usual) / totals[0]
            )
        return cls(math.log((hosts[1] + 1) / (hosts[0] + 1)), weight)

    def score(self, tokens: list[str]) -> float:
        return self.prior + sum(self.weight.get(t, 0.0) for t in tokens)


def tokens(text: str, words: Words) -> list[str]:
    """Words of a host or path: cut at signs, digit runs as one class, the rest segmented."""
    found = []
    for part in _PART.split(text.lower()):
        for run in _RUN.findall(part):
            found += ["#"] if run[0].isdigit() else words.split(run)
    return found


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(rest, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


@dataclass
class Filter:
    """Word model and classifier; splits each host once per worker."""

    words: Words
    bayes: Bayes
    size: int = field(default=100_000)

    def __getstate__(self):
        return {"words": self.words, "bayes": self.bayes, "size": self.size}

    def host_tokens(self, host: str) -> list[str]:
        if "_split" not in self.__dict__:
            self._split = lru_cache(self.size)(lambda h: tokens(h, self.words))
        return self._split(host)

    def blocks(self, host: str, path: str) -> bool:
        """A url without host has nothing to be judged by and passes."""
        return bool(host) and self.bayes.score(self.host_tokens(host) + tokens(path, self.words)) > 0


def weak_label(found: list[str], unwanted=frozenset(UNWANTED), weak=WEAK) -> int:
    named = unwanted.intersection(found)
    return int(bool(named - weak) or len(named) > 1)


def fit(pages: DataFrame, words: Words) -> Bayes:
    """Counts host and path words by class, in Spark. A word counts once for each host that
    has it, however many pages the host has."""
    spark = pages.sparkSession
    model = spark.sparkContext.broadcast(Filter(words, Bayes(0.0, {})))  # one vocabulary

    def url_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: dict[tuple[str, str, int], None] = {}
            for host, path in zip(batch["host"], batch["path"], strict=True):
                found = model.value.host_tokens(host)
                label = weak_label(found)
                for token in ("", *found, *tokens(path, model.value.words)):
                    rows[host, token, label] = None
            yield pd.DataFrame(list(rows), columns=["host", "token", "label"])

    url = F.col("url")
    rows = pages.select(host_of(url).alias("host"), path_of(url).alias("path")).where("host <> ''")
    counted = (
        rows.mapInPandas(url_words, "host string, token string, label int")
        .distinct()
        .groupBy("token")
        .agg(F.sum(1 - F.col("label")).alias("good"), F.sum("label").alias("bad"))
    )
    # Words of the vocabulary and the line of the hosts themselves: bounded by the vocabulary.
    known = spark.createDataFrame([(w,) for w in [*words.logp, ""]], "token string")
    counts = {r["token"]: (r["good"], r["bad"]) for r in counted.join(known, "token", "left_semi").collect()}
    return Bayes.from_counts(counts, counts.pop("", (0, 0)), words)


def judge(pages: DataFrame, vocabulary: str, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``(page_id, url)``.

    A null url or one without ``://`` has empty host and path, fits no rule and is
    allowed. Repeated rows are judged alike; other columns are ignored. An empty table
    gives an empty result.
    """
    words = Words.from_vocabulary(vocabulary, tuple(UNWANTED))
    model = pages.sparkSession.sparkContext.broadcast(Filter(words, fit(pages, words)))
    host, path = F.col("host"), F.col("path")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_for(host, path, rules)
    ruled = rows.select("*", rule.alias("rule"), verdict.alias("verdict"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            says = [
                v if isinstance(v, str) else ("block" if model.value.blocks(h, p) else "allow")
                for h, p, v in zip(batch["host"], batch["path"], batch["verdict"], strict=True)
            ]
            yield batch.assign(verdict=says)

    ruled = id_as_text(ruled, "page_id")
    return id_as_long(ruled.mapInPandas(run, ruled.schema), "page_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return judge(table(spark, sf_dir, "pages"), vocabulary)
