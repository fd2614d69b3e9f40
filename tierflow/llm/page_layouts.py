"""Made-up page layouts with known main text, to train the block labeller on.

Pages differ in their tags, class names, order and nesting, with and without elements
that say what they are. All words come from the pages given, so that words alone do not
tell main text from the rest.
"""

from __future__ import annotations

import random

# Class names and phrases that pages use for their parts.
MAIN = "content article post entry story body text main page single blog news".split()
NAVIGATION = "nav menu navbar navigation topbar links breadcrumb breadcrumbs tabs pagination toc".split()
HEADER = "header masthead banner brand logo top site-header hero branding".split()
FOOTER = "footer bottom copyright colophon site-footer legal foot".split()
SIDE = "sidebar side aside widget related recommended popular trending more archive tags".split()
NOTICE = "cookie consent notice alert banner popup modal newsletter subscribe gdpr message".split()
ADVERT = "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adslot".split()
FORM = "form search login signup contact subscribe newsletter".split()
COMMENT = "comments comment replies discussion reply responses disqus feedback thread".split()
SHARE = "share social follow tools actions meta byline".split()
PHRASES = {
    "nav": "Home|About|Contact|News|Products|Blog|Login|Search|Menu|Next|Previous|Archive".split("|"),
    "footer": "All rights reserved|Privacy policy|Terms of use|Contact us|Imprint|Copyright 2024".split("|"),
    "notice": "We use cookies|Accept all|Reject|Cookie settings|Subscribe to our newsletter|Sign up".split("|"),
    "ad": "Advertisement|Sponsored|Buy now|Shop now|Special offer|Click here|Free trial".split("|"),
    "form": "Name|Email|Message|Send|Submit|Password|Search|Your comment|Remember me".split("|"),
    "comment": "Reply|Report|Like|says|wrote|Leave a comment|Comments|minutes ago|2 days ago".split("|"),
    "share": "Share|Tweet|Print|Posted by|Follow us|Read more|5 min read".split("|"),
    "side": "Related articles|Popular|Most read|You may also like|Tags|Recent posts".split("|"),
}


class Layouts:
    def __init__(self, words: list[str], seed: int):
        self.rng = random.Random(seed)
        self.words = words or ["word"]

    def _text(self, low: int, high: int) -> str:
        words = self.rng.choices(self.words, k=self.rng.randint(low, high))
        out, start = [], True
        for w in words:
            out.append(w.capitalize() if start else w)
            start = self.rng.random() < 0.1
            out[-1] += "." if start else "," if self.rng.random() < 0.06 else ""
        return " ".join(out) + ("." if len(words) > 6 and out[-1][-1] not in ".," else "")

    def _leaf(self, tag: str, text: str, main: bool, found: list, link: float = 0.0) -> str:
        found.append((text, main))
        r = self.rng
        inner = text.replace("&", "&amp;")
        if r.random() < link:
            inner = f'<a href="/{r.randint(1, 99)}">{inner}</a>'
        elif r.random() < 0.15 and len(text) > 12:
            inner = f"<{r.choice(['b', 'em', 'span', 'strong'])}>{inner}</span>" if r.random() < 0.3 else f"<b>{inner}</b>"
        end = "" if tag in ("p", "li") and r.random() < 0.2 else f"</{tag}>"
        return f"<{tag}>{inner}{end}"

    def _box(self, names: list[str], semantic: str | None, inner: str, plain: float) -> str:
        r = self.rng
        tag = semantic if semantic and r.random() < 0.5 else r.choice(["div", "div", "section"])
        name = ""
        if r.random() > plain:
            value = r.choice(names) + r.choice(["", "", "-wrap", "-box", " inner", "__list", "1"])
            name = f' {r.choice(["class", "class", "id"])}="{value}"'
        elif r.random() < 0.5:
            name = f' class="{r.choice("abcdefg")}{r.randint(1, 99)}"'
        return f"<{tag}{name}>{inner}</{tag}>"

    def _phrase(self, kind: str) -> str:
        return self.rng.choice(PHRASES[kind]) if self.rng.random() < 0.6 else self._text(1, 4)

    def _list(self, kind: str, found: list, low: int, high: int) -> str:
        items = [self._leaf("li", self._phrase(kind), False, found, 0.9) for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.25:
            return "".join(i.replace("<li>", "<div>").replace("</li>", "</div>") for i in items)
        return f"<ul>{''.join(items)}</ul>"

    def _part(self, kind: str, found: list, plain: float) -> str:
        r = self.rng
        if kind == "nav":
            return self._box(NAVIGATION, "nav", self._list("nav", found, 3, 9), plain)
        if kind == "header":
            inner = self._leaf(r.choice(["h1", "div", "p"]), self._text(1, 4), False, found, 0.5)
            inner += self._leaf("p", self._text(2, 9), False, found) if r.random() < 0.5 else ""
            return self._box(HEADER, "header", inner, plain)
        if kind == "footer":
            inner = "".join(
                self._leaf("p", r.choice(["© ", ""]) + (self._phrase("footer") if r.random() < 0.6 else self._text(4, 20)), False, found)
                for _ in range(r.randint(1, 3))
            )
            return self._box(FOOTER, "footer", inner if r.random() < 0.7 else inner + self._list("footer", found, 2, 4), plain)
        if kind == "side":
            inner = self._leaf(r.choice(["h2", "h3", "h4"]), self._phrase("side"), False, found)
            inner += self._list("side", found, 2, 6)
            inner += self._leaf("p", self._text(6, 30), False, found) if r.random() < 0.4 else ""
            return self._box(SIDE, "aside", inner, plain)
        if kind == "form":
            fields = "".join(
                self._leaf(r.choice(["div", "p", "button"]), self._phrase("form"), False, found) + "<input>"
                for _ in range(r.randint(1, 4))
            )
            return f"<form>{fields}</form>" if r.random() < 0.6 else self._box(FORM, "form", fields, min(plain, 0.3))
        if kind == "comment":
            inner = self._leaf(r.choice(["h2", "h3"]), self._phrase("comment"), False, found)
            for _ in range(r.randint(1, 6)):
                one = self._leaf("div", f"{self._text(1, 2)} {r.choice(PHRASES['comment'])}", False, found)
                one += self._leaf("p", self._text(4, 60), False, found)
                inner += self._box(COMMENT, None, one, min(plain, 0.5))
            return self._box(COMMENT, "section", inner, min(plain, 0.3))
        names = {"notice": NOTICE, "ad": ADVERT, "share": SHARE}[kind]
        inner = "".join(
            self._leaf(r.choice(["p", "div", "span"]), self._phrase(kind) if r.random() < 0.5 else self._text(3, 25), False, found)
            for _ in range(1 if r.random() < 0.6 else 2)
        ).replace("<span>", "<div>").replace("</span></div>", "</div>")
        return self._box(names, None, inner, min(plain, 0.4))

    def _main(self, found: list, plain: float) -> str:
        r = self.rng
        inner = ""
        if r.random() < 0.85:
            inner += self._leaf(r.choice(["h1", "h1", "h2"]), self._text(2, 14), True, found)
        if r.random() < 0.25:
            inner += self._part("share", found, plain)
        for k in range(r.choice([1, 2, 3, 4, 5, 8, 14])):
            kind = r.random()
            if kind < 0.78:
                inner += self._leaf("p", self._text(*r.choice([(1, 4), (3, 12), (12, 50), (40, 140)])), True, found)
            elif kind < 0.86:
                inner += self._leaf(r.choice(["h2", "h3"]), self._text(2, 8), True, found)
            elif kind < 0.92:
                inner += "<ul>" + "".join(self._leaf("li", self._text(3, 20), True, found) for _ in range(r.randint(2, 5))) + "</ul>"
            elif kind < 0.96:
                inner += f"<blockquote>{self._leaf('p', self._text(8, 40), True, found)}</blockquote>"
            else:
                inner += self._part("ad", found, plain)
        if r.random() < 0.06:  # the same short line over and over
            line = self._text(1, 8)
            inner += "".join(self._leaf("p", line, True, found) for _ in range(r.randint(8, 40)))
        if r.random() < 0.4:
            return f"<article>{inner}</article>"
        box = self._box(MAIN, r.choice(["article", "main", "section"]), inner, plain)
        return self._box(MAIN, "main", box, plain) if r.random() < 0.3 else box

    def page(self) -> tuple[str, list[tuple[str, bool]]]:
        """A page and its blocks in order, each with whether it is main text."""
        r = self.rng
        plain = r.choice([0.0, 0.2, 0.2, 0.5, 0.9])
        found: list[tuple[str, bool]] = []
        before = [k for k, p in (("notice", 0.3), ("header", 0.5), ("nav", 0.8), ("form", 0.15), ("ad", 0.4), ("side", 0.15)) if r.random() < p]
        after = [k for k, p in (("share", 0.2), ("comment", 0.35), ("side", 0.35), ("form", 0.2), ("ad", 0.2), ("nav", 0.15), ("footer", 0.85), ("notice", 0.1)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(before)
        body = "".join(self._part(k, found, plain) for k in before)
        if r.random() < 0.96:
            body += self._main(found, plain)
        body += "".join(self._part(k, found, plain) for k in after)
        return f"<html><head><title>{self._text(2, 6)}</title></head><body>{body}</body></html>", found
