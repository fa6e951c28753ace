"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page's leaf blocks, the stretches of text between block-level tags, form a chain. Features
of a block are its ancestors' tags and the words of their classes and ids, its parent, length,
share of linked text and punctuation. The field is trained on labelled pages that ``labelled_pages``
lays out from a seed in many layouts, by gradient steps on forward-backward
marginals, and decoded by Viterbi; blocks labelled main text are joined in page order.

Character references are decoded, white space in a block becomes one space, and nothing else is
dropped or cut. End tags that HTML lets be left out may be; controls of forms hold no text. Defined
results: null, empty and text-free pages give an empty text. A tag cut off by the end of the page, a name with
attributes, is markup; elements left open end with the page. Repeated rows are alike.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's void elements, elements whose text is no text of the page, and block-level elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg iframe head title canvas audio video select textarea datalist button".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript template".split())
BLOCKS = frozenset(
    "html body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre form fieldset legend figure figcaption address details summary dialog menu hr center button option select textarea label".split()
)
#: What the start of an element ends, if open: as in HTML's rules of optional tags.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}} | dict.fromkeys(("thead", "tbody", "tfoot"), {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"})
SCOPES = frozenset("ul ol dl table div article section main body html form nav aside header footer select blockquote".split())
#: Places of features.
PLACES = 1 << 13
#: Pages that the field is trained on, and passes.
PAGES, EPOCHS = 700, 8


@dataclass
class Block:
    text: str
    parent: str
    around: tuple | None  # names that all open elements bring, each once: (new names of the innermost that has any, those around it)
    linked: int


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[str], tuple | None]] = []
        self.names: set[str] = set()
        self.open: Counter = Counter()
        self.silent = 0
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                parent, _, around = self.stack[-1] if self.stack else ("none", [], None)
                self.blocks.append(Block(text, parent, around, self.linked))
            self.text, self.linked = [], 0

    def pop(self) -> None:
        tag, new, _ = self.stack.pop()
        self.names.difference_update(new)
        self.open[tag] -= 1
        self.silent -= tag in SILENT

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            self.close("title")
        if self.open["head"] and tag not in HEAD_ONLY and not self.open["noscript"] and not self.open["template"]:
            self.close("head")  # its end tag may be left out
        if tag in BLOCKS:
            self.flush()
            if self.open["p"] and tag not in ("label", "button", "option", "select", "textarea"):
                self.close("p")
            if ends := ENDS.get(tag):
                for i in range(len(self.stack) - 1, -1, -1):
                    if self.stack[i][0] in ends:
                        del_to = i
                        while len(self.stack) > del_to:
                            self.pop()
                    elif self.stack[i][0] in SCOPES:
                        break
        elif tag == "br":
            self.text.append(" ")
        if tag not in VOID:
            names = {f"t {tag}", *(f"c {w}" for k, v in attrs if k in ("class", "id", "role") and v for w in re.findall(r"[a-z]+", v.lower()))}
            new = list(names - self.names)
            self.names.update(new)
            outer = self.stack[-1][2] if self.stack else None
            self.stack.append((tag, new, (new, outer) if new else outer))
            self.open[tag] += 1
            self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def close(self, tag: str | None = None) -> None:
        if tag is None:
            super().close()
            self.flush()
        elif self.open[tag]:
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.close(tag)

    def handle_data(self, data: str) -> None:
        if self.silent and self.stack[-1][0] == "head" and data.strip():
            self.close("head")
        if not self.silent:
            self.text.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())


_LAST = re.compile(r"<([a-zA-Z/!][^<>]*)\Z")


def _ended(html: str) -> str:
    """html without a tag that its end cuts off; what is no such tag, as words without values follow its name, stays as text."""
    if not (m := _LAST.search(html)):
        return html
    tag = all("=" in x for x in re.sub(r"""(["'])[^"']*(\1|\Z)""", "", m[1]).split()[1:-1])
    return html[: m.start()] + ("" if tag else "&lt;" + m[1])


def leaf_blocks(html: str) -> list[Block]:
    tree = _Tree()
    tree.feed(_ended(html))
    tree.close()
    return tree.blocks


def features(b: Block) -> list[int]:
    n, words = len(b.text), b.text.count(" ") + 1
    link = min(4, int(5 * b.linked / n))
    marks = min(3, sum(b.text.count(c) for c in ".!?,;"))
    names = {"1", f"p {b.parent}", f"n {int(math.log2(n + 1))}", f"w {min(9, words)}", f"a {link}", f"m {marks}", f"e {b.text[-1] in '.!?'}", f"an {link} {min(3, words // 4)}"}
    if b.text[0] in "©®":
        names.add("c")
    around = b.around
    while around:
        new, around = around
        names.update(new)
    return [zlib.crc32(x.encode()) % PLACES for x in names]


@dataclass
class Field:
    emit: np.ndarray = field(default_factory=lambda: np.zeros((PLACES, 2)))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def scores(self, page: Iterable[list[int]]) -> np.ndarray:
        return np.array([self.emit[f].sum(0) for f in page])

    def decode(self, page: Iterable[list[int]]) -> list[int]:
        """Viterbi."""
        s = self.scores(page).tolist()
        (t00, t01), (t10, t11) = self.step.tolist()
        a, b = self.start[0] + s[0][0], self.start[1] + s[0][1]
        back = []
        for e0, e1 in s[1:]:
            back.append((int(b + t10 > a + t00), int(b + t11 > a + t01)))
            a, b = max(a + t00, b + t10) + e0, max(a + t01, b + t11) + e1
        out = [int(b > a)]
        for x in reversed(back):
            out.append(x[out[-1]])
        return out[::-1]

    def marginals(self, page: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: of each block's label, and summed, of each step between labels."""
        s = self.scores(page)
        n = len(s)
        fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
        fwd[0] = self.start + s[0]
        for i in range(1, n):
            fwd[i] = np.logaddexp(fwd[i - 1][0] + self.step[0], fwd[i - 1][1] + self.step[1]) + s[i]
        for i in range(n - 2, -1, -1):
            x = bwd[i + 1] + s[i + 1]
            bwd[i] = np.logaddexp(self.step[:, 0] + x[0], self.step[:, 1] + x[1])
        z = np.logaddexp(*fwd[-1])
        steps = np.zeros((2, 2))
        for i in range(1, n):
            steps += np.exp(fwd[i - 1][:, None] + self.step + (s[i] + bwd[i])[None] - z)
        return np.exp(fwd + bwd - z), steps

    def learn(self, page: list[list[int]], labels: list[int], rate: float, decay: float = 1e-4) -> None:
        p, steps = self.marginals(page)
        for f, y, q in zip(page, labels, p, strict=True):
            g = -q
            g[y] += 1
            self.emit[f] += rate * (g - decay * self.emit[f])
        seen = np.zeros((2, 2))
        for a, b in zip(labels[:-1], labels[1:], strict=True):
            seen[a, b] += 1
        self.step += rate * (seen - steps) / max(1, len(page) - 1)
        first = -p[0]
        first[labels[0]] += 1
        self.start += rate * first


class _Layouts:
    """Pages of many layouts from one seed."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.main: set[str] = set()

    def say(self, low: int, high: int, end: bool = True) -> str:
        words = ["".join(self.r.choices("abcdefghijklmnoprstuvz", k=self.r.randint(2, 9))) for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.2:
            words = [w + self.r.choice(["***", "%%%", "$$$", ",", "!!", " |"]) for w in words]
        text = " ".join(words).capitalize()
        return (text.upper() if self.r.random() < 0.1 else text) + ("." if end else "")

    def good(self, low: int, high: int, end: bool = True) -> str:
        text = self.say(low, high, end)
        self.main.add(" ".join(text.split()))
        return text

    def pick(self, *names: str) -> str:
        return self.r.choice(names)

    def links(self, low: int, high: int) -> str:
        item = lambda: f'<li><a href="/{self.say(1, 1, False)}">{self.say(1, 3, False)}</a></li>'
        return "<ul>" + "".join(item() for _ in range(self.r.randint(low, high))) + "</ul>"

    def box(self, tag: str, name: str, inner: str) -> str:
        kind = self.pick("class", "id", "class")
        return f'<{tag} {kind}="{name}">{inner}</{tag}>' if name else f"<{tag}>{inner}</{tag}>"

    def noise(self, where: str) -> str:
        r, p = self.r, self.pick
        word = lambda a, b: f"<p>{self.say(a, b)}</p>" if r.random() < 0.6 else self.say(a, b)
        kinds = {
            "nav": lambda: self.box(p("nav", "nav", "div"), p("nav", "menu", "navbar", "breadcrumb", "navigation"), self.links(2, 8)),
            "header": lambda: self.box(p("header", "header", "div"), p("header", "masthead", "topbar", "site-header"), self.pick(f"<h1>{self.say(1, 4, False)}</h1>", f"<div>{self.say(1, 5, False)}</div>") + word(3, 12)),
            "ad": lambda: self.box(p("div", "div", "aside", "section"), p("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo"), word(3, 25)),
            "notice": lambda: self.box(p("div", "section", "dialog"), p("cookie", "cookie-notice", "consent", "notice", "gdpr", "alert", "popup", "modal"), word(5, 30) + p("", f"<button>{self.say(1, 2, False)}</button>")),
            "aside": lambda: self.box(p("aside", "aside", "div"), p("sidebar", "side", "widget", "related", "recommended", "trending"), f"<h3>{self.say(1, 3, False)}</h3>" + p(self.links(2, 6), word(5, 25))),
            "share": lambda: self.box("div", p("share", "social", "tags", "author-box", "newsletter"), p(self.links(2, 4), word(2, 10))),
            "form": lambda: self.box("form", p("", "search", "subscribe", "newsletter", "contact"), f"<label>{self.say(1, 3, False)}</label><input name=q><button>{self.say(1, 2, False)}</button>" + p("", word(4, 15))),
            "comments": lambda: self.box(p("section", "div", "ol"), p("comments", "comment-list", "responses", "disqus", "replies"), f"<h3>{self.say(1, 3, False)}</h3>" + "".join(self.box(p("div", "article", "li"), p("comment", "reply"), p(f"<b>{self.say(1, 2, False)}</b>", "") + word(4, 40)) for _ in range(r.randint(1, 4)))),
            "footer": lambda: self.box(p("footer", "footer", "div"), p("footer", "site-footer", "copyright", "bottom"), p("&copy; ", "") + self.say(2, 25) + p("", self.links(1, 5))),
        }
        bare = lambda s: re.sub(r'^<(nav|header|aside|footer) (class|id)="[^"]*"', r"<\1", s) if r.random() < 0.5 else s
        return bare(kinds[where]())

    def body(self) -> str:
        r, out = self.r, []
        if r.random() < 0.8:
            out.append(f"<{(h := self.pick('h1', 'h1', 'h2'))}>{self.good(1, 10, False)}</{h}>")
        for _ in range(r.choice([1, 1, 2, 3, 5, 9, 16])):
            kind = r.random()
            text = self.good(1, self.pick(2, 8, 30, 120), r.random() < 0.8)
            if kind < 0.66:
                out.append(f"<p>{text}" + self.pick("</p>", "</p>", "<br>"))
            elif kind < 0.72:
                out.append(f"<h2>{text}</h2>")
            elif kind < 0.78:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.good(1, 12)}</li>" for _ in range(r.randint(1, 4))) + f"</ul><p>{text}</p>")
            elif kind < 0.88:
                out.append(f"<pre>{text}</pre>")
            elif kind < 0.92:
                out.append(f"<table><tr><td>{text}</td><td>{self.good(1, 4)}</td></tr></table>")
            elif kind < 0.96:
                out.append(f"<div>{text}</div>")
            else:
                out.append(f'<p><a href="/x">{text}</a></p>')
            if r.random() < 0.05:
                out.append(self.noise(self.pick("ad", "share", "aside", "form", "notice")))
        return "".join(out)

    def page(self) -> tuple[str, set[str]]:
        self.main = set()
        r, p = self.r, self.pick
        inner = self.body()
        if r.random() < 0.25:
            inner += self.noise(p("comments", "share", "footer", "nav"))
        if r.random() < 0.15:
            inner = self.noise("header").replace("<h1>", "<div>").replace("</h1>", "</div>") + inner
        shell = r.random()
        if shell < 0.45:
            inner = self.box("article", p("", "", "post", "entry", "story"), inner)
        elif shell < 0.65:
            inner = self.box("main", p("", "main", "content"), inner)
        elif shell < 0.88:
            inner = self.box(p("div", "section", "td"), p("content", "article-body", "post", "entry-content", "story", "main", "text", "body-text"), inner)
        if shell < 0.93 or r.random() < 0.3:
            before = [self.noise(k) for k in ("nav", "header", "ad", "notice", "aside", "form") if r.random() < 0.45]
            after = [self.noise(k) for k in ("comments", "aside", "share", "ad", "footer", "form", "notice", "nav") if r.random() < 0.4]
            r.shuffle(before)
            inner = "".join(before) + inner + "".join(after)
        if r.random() < 0.3:
            inner = f'<div {p("class", "id")}="{p("wrapper", "page", "container", "wrap")}">{inner}</div>'
        head = f"<head><title>{self.say(2, 6, False)}</title><style>p{{margin:0}}</style></head>" if r.random() < 0.8 else ""
        return f"<html>{head}<body>{inner}</body></html>" if r.random() < 0.92 else inner, self.main


def labelled_pages(n: int, seed: int = 11) -> Iterator[tuple[list[Block], list[int]]]:
    """Leaf blocks of pages with 1 for main text."""
    make = _Layouts(seed)
    while n:
        html, main = make.page()
        if blocks := leaf_blocks(html):
            n -= 1
            yield blocks, [int(b.text in main) for b in blocks]


@cache
def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 11) -> Field:
    """The field fitted on pages of a seed; once in a process for the same arguments."""
    data = [([features(b) for b in blocks], labels) for blocks, labels in labelled_pages(pages, seed)]
    model, order = Field(), random.Random(seed)
    for epoch in range(epochs):
        order.shuffle(data)
        for page, labels in data:
            model.learn(page, labels, 0.2 / (1 + epoch))
    return model


def main_text(html: str | None, model: Field) -> str:
    blocks = leaf_blocks(html or "")
    if not blocks:
        return ""
    return " ".join(b.text for b, y in zip(blocks, model.decode(features(b) for b in blocks), strict=True) if y)


def extract(pages: DataFrame, model: Field, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with their main text."""

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, model) for h in html], dtype=object)

    return pages.withColumn(text_col, text(F.col(html_col)))
