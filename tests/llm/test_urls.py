"""URL filter: parts and rules against plain code, segmentation, verdicts."""

import public_tokenizers
import pytest

from tierflow.llm.urls import UNWANTED, Words, judge, tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = [("net", "/"), ("example.net", "/en/"), ("example.com", "/de/"), ("org", "/fr/")]
SAYS = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
URLS = [
    "http://a.example.net/en/1", "http://a.example.net/de/1", "http://a.net", "http://a.net/", "http://net/x",
    "http://xnet/", "http://EXAMPLE.com/de/?q=1", "http://example.com/de", "http://b.example.com/de/x#y/z",
    "https://c.org/fr/", "https://c.org/FR/", "https://org.example.com/fr/", "x://h?p/q", "x://h#p/q", "x://",
    "no scheme", "", None, "u?a=http://late.net/x", "http://two://x.org/fr/", "http://\u00c9X.org/fr/a\nb?c",
    "http://casinobets.example.com/fr/1", "https://www.freepokerslots.example.com/x", "http://blog.garden.example.com/en/3",
    "http://gardentools.example.com/", "http://garden.example.com/",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Words.from_vocabulary(VOCABULARY, tuple(UNWANTED))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return host, path[:end]


def rule(host, path):
    fits = [
        h + p for h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits, key=len, default=None)


def test_parts_rules_and_verdicts(spark):
    rows = [(i if i % 5 else None, u, "x") for i, u in enumerate(URLS)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, host string"), VOCABULARY).collect()
    assert len(got) == len(URLS)
    want = sorted(((i, *parts(u), rule(*parts(u))) for i, u, _ in rows), key=str)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == want
    for r in got:
        if r["rule"]:
            assert r["verdict"] == SAYS[r["rule"]]
    by_host = {r["host"]: r["verdict"] for r in got}
    assert by_host["casinobets.example.com"] == by_host["www.freepokerslots.example.com"] == "block"
    assert by_host["garden.example.com"] == by_host["gardentools.example.com"] == by_host[""] == "allow"


@pytest.mark.parametrize(
    "text, words",
    [
        ("cheappills", ["cheap", "pills"]),
        ("free-bets2go", ["free", "bets", "#", "go"]),
        ("onlinecasinowinner", ["online", "casino", "winner"]),
        ("", []),
        ("--..", []),
    ],
)
def test_segmentation(vocabulary, text, words):
    assert tokens(text, vocabulary) == words


def test_segmentation_is_the_best_path(vocabulary):
    small = Words({"a": -1.0, "ab": -1.5, "b": -2.0, "ba": -0.5, "bab": -4.0}, 3, -10.0)

    def best(run):
        if not run:
            return 0.0
        found = [small.unknown + best(run[1:])]
        found += [p + best(run[len(w) :]) for w, p in small.logp.items() if run.startswith(w)]
        return max(found)

    for run in ("abab", "babab", "xab", "abxba", "xx"):
        cost = sum(small.logp.get(w, small.unknown * len(w)) for w in small.split(run))
        assert "".join(small.split(run)) == run and cost == pytest.approx(best(run))


def test_long_url(vocabulary):
    assert len("".join(tokens("ab" * 50_000, vocabulary))) == 100_000


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string"), VOCABULARY).count() == 0
