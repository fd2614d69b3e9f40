"""Blocks of odd markup, gradients, and held-out accuracy of the labeller."""

import zlib

import numpy as np
import pytest

from tierflow.llm import html_extraction
from tierflow.llm.html_extraction import Labeller, Settings, extract, features, made_pages
from tierflow.llm.page_blocks import blocks_of

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
UNCLOSED = ["svg", "math", "object", "audio", "video", "template"]
SMALL = Settings(layouts=900, epochs=8)


@pytest.mark.parametrize(
    "html, texts",
    [
        ("", []),
        ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b <b>c</b>\n d<div>e</div>f", ["a", "b c d", "e", "f"]),
        ("<ul><li>x<li>y<ul><li>z</ul></ul>w", ["x", "y", "z", "w"]),
        ("<script>var t='</p>';</script><style>p{}</style><p>t", ["t"]),
        ("<head><title>no</title><body><p>yes", ["yes"]),
        ("<head><script>a<b</script></head><p>1 < 2 &lt; 3<!-- no > -- ->yes</p>", ["1 < 2 < 3"]),
        ("<p title='a>b'>q</p><p class=\"x>q\">r<br>s</p><p>t&nbsp;&#233;&#x4e2d;&bogus;", ["q", "r s", "t \u00e9\u4e2d&bogus;"]),
        ("<td>1<td>2<tr><td>3</table>4</div></p>5", ["1", "2", "3", "4", "5"]),
        ("<p>cut <fo", ["cut"]),
        ("<p>cut <a href='x", ["cut"]),
        ("<script>never closed <p>x", []),
        ("<P CLASS='A'>up</P>", ["up"]),
        ("<html><head><title>t</title><meta a><h1>Article</h1><p>x", ["Article", "x"]),
        ("<head><template><p>no</p></template><style>p{}</style>\n</head><p>yes", ["yes"]),
        ("<head><title>t</title>text<p>yes", ["text", "yes"]),
        *((f"<p>a<{t} b='c'>no<p>d</p><div>e</div>", ["a", "d", "e"]) for t in UNCLOSED),
        *((f"<p>a</p><{t}>no<p>no</p></{t.upper()}>f", ["a", "f"]) for t in UNCLOSED),
        *((f"<{t}>no<p>a</p><{t}><p>no</p></{t}>b<{t}>no<p>c", ["a", "b", "c"]) for t in UNCLOSED),
        *((f"<{t}><{t}><p>no</p></{t}>no</{t}>yes<{t}/>too", ["yestoo"]) for t in UNCLOSED),
        ("<object><p>a<svg><p>b</p><object><p>no</object>c", ["a", "b", "c"]),
        ("\u0130" * 20 + "<script>no</SCRIPT><title>no</title>yes", ["\u0130" * 20 + "yes"]),
        ("<script>a</scripts></\u017fcript>no</script >yes", ["yes"]),
    ],
)
def test_blocks(html, texts):
    assert [b.text for b in blocks_of(html)] == texts


def test_gradients():
    s = Settings(buckets=16, embed=3, hidden=4)
    model = Labeller.new(s)
    pages, labels = made_pages(WORDS, 4, 1, s)
    grads = model.step(pages, labels)

    def loss():
        x, mask, _, t, p = model._inputs(pages)
        z = model._logits(x, mask)[0][t, p]
        y = np.concatenate(labels)
        return (np.logaddexp(0, z) - y * z).mean()

    rng = np.random.default_rng(0)
    for name, w in model.weights.items():
        for _ in range(3):
            at = tuple(rng.integers(n) for n in w.shape)
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_layouts():
    pages, labels = made_pages(WORDS, SMALL.layouts, 5, SMALL)
    model = Labeller.new(SMALL)
    model.train(pages, labels)
    pages, labels = made_pages([w[::-1] for w in WORDS], 200, 77, SMALL)
    got = model.label(pages)
    truth = np.concatenate(labels) > 0
    assert (np.concatenate(got) == truth).mean() > 0.96
    alone = [model.label([p])[0] for p in pages[:20]]
    assert all((a == b).all() for a, b in zip(alone, got))


def test_rows(spark):
    body = " ".join(WORDS * 3).capitalize() + "."
    page = (
        "<html><head><title>no</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>Blog</a>"
        f"</li></ul></nav><article><h1>Alpha beta</h1><p>{body}</p><p>{body}</p></article>"
        "<footer><p>\u00a9 All rights reserved</p></footer></body></html>"
    )
    rows = [(1, "u", page, "x"), (1, "u", page, "x"), (None, None, None, None), (2, "v", "", "y"), (3, "w", "<nav>", "z")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), SMALL).collect()
    want = f"Alpha beta\n{body}\n{body}"
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "u", want, len(want))] * 2 + [(None, None, "", 0), (2, "v", "", 0), (3, "w", "", 0)], key=str
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(empty, Settings(layouts=8, epochs=1)).count() == 0


def test_long_page_is_whole():
    page = blocks_of("".join(f"<p>{i} {'word ' * (i % 90)}</p>" for i in range(3000)) + "x" * 200_000)
    assert len(page) == 3001 and len(page[-1].text) == 200_000
    s = Settings()
    assert len(Labeller.new(s).label([features(page, s)])[0]) == 3001


def test_all_words_names_and_digits_of_a_block_count():
    s = Settings()
    ahead = " ".join(f"w{i}" for i in range(400))
    utilities = " ".join(f"u{'abcdefgh'[i]}" for i in range(8))
    pages = [
        f"<div>{ahead} one</div>",
        f"<div>{ahead} two</div>",
        f"<div class='{utilities} sidebar'>{ahead} one</div>",
        f"<div class='{utilities} comments'>{ahead} one</div>",
        f"<div>{ahead} {'7' * 500}</div>",
    ]
    paths, words, numbers = zip(*(features(blocks_of(p), s) for p in pages), strict=True)
    bags = [dict(w[0].T.tolist()) for w in words]
    assert [sum(b.values()) for b in bags] == [401] * 5 and bags[0] != bags[1]
    assert "class:sidebar" in blocks_of(pages[2])[0].path
    assert dict(paths[2][0].T.tolist()) != dict(paths[3][0].T.tolist())
    text = blocks_of(pages[4])[0].text
    assert numbers[4][0, 4] == sum(c.isdigit() for c in text) / len(text) > numbers[0][0, 4]
    x = Labeller.new(s)._inputs([features(blocks_of(pages[0]), s)])[0][0, 0]
    names = [zlib.crc32(w.encode()) % s.buckets for w in f"{ahead} one".split()]
    assert x[s.embed : 2 * s.embed] == pytest.approx(Labeller.new(s).weights["word"][names].mean(0))


def test_unclosed_elements_are_read_in_linear_time():
    page = "".join(f"<{UNCLOSED[i % 6]}><p>{i}</p>" for i in range(20_000))
    assert [b.text for b in blocks_of(page)] == [str(i) for i in range(20_000)]


def test_names_are_hashed_once_and_counted_as_before(monkeypatch):
    s, told, plain = Settings(buckets=64), [], zlib.crc32
    page = blocks_of("<div class='a'><p>some words some ٣ 1 words</p><p>words 22</p></div>")
    html_extraction._Buckets.of.cache_clear()
    monkeypatch.setattr(html_extraction.zlib, "crc32", lambda b: told.append(b) or plain(b))
    for _ in range(2):
        _, words, numbers = features(page, s)
    html_extraction._Buckets.of.cache_clear()
    assert len(told) == len(set(told))
    for block, found, row in zip(page, words, numbers, strict=True):
        want = {}
        for w in block.text.lower().split():
            b = plain(w.encode()) % 64
            want[b] = want.get(b, 0) + 1
        assert dict(found.T.tolist()) == want
        assert row[0] == np.log1p(len(block.text)) / 6
        assert row[4] == sum(map(str.isdigit, block.text)) / len(block.text)
