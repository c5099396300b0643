"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks: stretches of text between the
tags that break a line. Every block has features of the tags and class words
above it, its own tag and its text. The chain labels each block main text or
not: learned weights score features per label and label changes, Viterbi picks
the best labels of the whole page. Weights are fitted by gradient ascent on the
exact log-likelihood (forward-backward) over labelled pages of many layouts,
made here by ``labelled_pages``; no page that is extracted is learned from.

Text of scripts, styles, templates, forms' controls, comments and markup is
never part of a block. Character references are decoded, white space inside a
block becomes one space, and main blocks are joined in page order by blank
lines.

Defined results: null or empty html gives an empty text; html without tags is
one block. Markup that is never closed is closed at the end of the page. Rows
with null ids or repeated rows are extracted alike. Columns beyond page_id,
url and html are carried through.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from adloom.llm.workspace import spare_name

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset("script style noscript template head title textarea select option button svg math iframe object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: Opening one of these ends an open p.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
    "ol p pre section table ul".split()
)
P_BARRIERS = frozenset("article div section body td li".split())
HEAD_BARRIERS = frozenset({"template", "body"})
#: Opening one of these ends an open one of its kind, up to these parents.
SELF_ENDING = {
    "li": frozenset({"ul", "ol", "menu"}),
    "tr": frozenset({"table"}),
    "td": frozenset({"tr", "table"}),
    "th": frozenset({"tr", "table"}),
    "dt": frozenset({"dl"}),
    "dd": frozenset({"dl"}),
}
#: All that can stand in a head; other tags, and text, end it and begin the body.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())

_CLASS_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """One leaf block: its text, the path of (tag, class words) above it, and how much of it is links."""

    path: tuple[tuple[str, frozenset[str]], ...]
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


#: A comment, a tag with its name and attributes, or other markup; what is cut off by the end of the page counts as markup.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NO_WORDS: frozenset[str] = frozenset()
#: Tags whose content is not markup.
RAW = frozenset("script style textarea title iframe noembed noframes".split())


class _Reader:
    def __init__(self):
        self.stack: list[tuple[str, frozenset[str]]] = []
        self.silent = 0
        self.links = 0
        self.blocks: list[Block] = []
        self.open: Block | None = None

    def read(self, html: str) -> None:
        at = 0
        while True:
            found = _MARKUP.search(html, at)
            begin = found.start() if found else len(html)
            if begin > at:
                self.data(html[at:begin])
            if not found:
                break
            at = found.end()
            end, tag, rest = found[1], found[2], found[3]
            if tag is None:
                end, tag, rest = found[4], found[5], found[6]
                if tag is None:
                    continue
            tag = tag.lower()
            if end:
                self.end(tag)
                continue
            self.begin(tag, rest)
            if tag in RAW and not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)
        self.end_block()

    def end_block(self) -> None:
        if self.open is not None and any(not p.isspace() for p in self.open.parts):
            self.blocks.append(self.open)
        self.open = None

    def begin(self, tag: str, rest: str) -> None:
        if tag == "br":
            self.end_head()
            if self.open is not None:
                self.open.parts.append(" ")
            return
        if tag in ("body", "frameset"):
            self.pop_to("head", HEAD_BARRIERS)
        elif tag not in IN_HEAD:
            self.end_head()
        if tag in ENDS_P:
            self.pop_to("p", P_BARRIERS)
        if tag in SELF_ENDING:
            self.pop_to(tag, SELF_ENDING[tag])
        if tag not in INLINE:
            self.end_block()
        if tag in VOID:
            return
        words = _NO_WORDS
        if "=" in rest:
            words = frozenset(w for v in _NAMES.findall(rest) for w in _CLASS_WORD.findall(v.lower())) or _NO_WORDS
        if rest.endswith("/") and tag in ("svg", "path", "iframe"):
            return
        self.stack.append((tag, words))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def end_head(self) -> None:
        """End a head that is the innermost open tag; the body is implied."""
        if self.stack and self.stack[-1][0] == "head":
            self.drop(len(self.stack) - 1)
            if not any(t == "body" for t, _ in self.stack):
                self.stack.append(("body", _NO_WORDS))

    def pop_to(self, tag: str, barriers: frozenset[str]) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.drop(i)
                return
            if self.stack[i][0] in barriers:
                return

    def drop(self, at: int) -> None:
        for t, _ in self.stack[at:]:
            if t not in INLINE:
                self.end_block()
            self.silent -= t in SILENT
            self.links -= t == "a"
        del self.stack[at:]

    def end(self, tag: str) -> None:
        if tag in ("body", "html", "br"):
            self.end_head()
        if tag not in INLINE:
            self.end_block()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.drop(i)
                return

    def data(self, data: str) -> None:
        if self.silent and not data.isspace():
            self.end_head()
        if self.silent:
            return
        if "&" in data:
            data = unescape(data)
        if self.open is None:
            if data.isspace():
                return
            self.open = Block(tuple(self.stack))
        self.open.parts.append(data)
        if self.links:
            self.open.linked += len(data)


def blocks_of(html: str) -> list[Block]:
    reader = _Reader()
    reader.read(html)
    return reader.blocks


# --- features -------------------------------------------------------------------

#: Words of tags and classes that carry meaning by themselves, each a feature of its own.
KNOWN = tuple(
    "article main section header footer nav aside form figure figcaption table blockquote pre h1 h2 h3 h4 p li div td span a body "
    "ad ads advert advertisement sponsored promo banner cookie consent notice alert popup modal newsletter subscribe login search "
    "menu navbar navigation breadcrumb breadcrumbs sidebar side widget related recommended share social tags meta byline author date "
    "copyright legal comment comments reply respond disqus content post entry story text body title headline main article page "
    "teaser pager pagination toolbar skip".split()
)
KNOWN = tuple(dict.fromkeys(KNOWN))
_AT = {w: i for i, w in enumerate(KNOWN)}
_MARKS = re.compile(r"[.!?…]")
_DIGITS = re.compile(r"\d")
TEXT_FEATURES = 16
SIZE = 2 * len(KNOWN) + TEXT_FEATURES


@functools.lru_cache(maxsize=4096)
def _path_features(path: tuple[tuple[str, frozenset[str]], ...]) -> np.ndarray:
    """Words of the ancestors, then words of the innermost tag that makes a block."""
    row = np.zeros(2 * len(KNOWN), np.float32)
    for tag, words in path:
        row[[_AT[w] for w in (tag, *words) if w in _AT]] = 1
    for tag, words in [x for x in path if x[0] not in INLINE][-1:]:
        row[[len(KNOWN) + _AT[w] for w in (tag, *words) if w in _AT]] = 1
    return row


def features(blocks: list[Block]) -> np.ndarray:
    """(blocks, SIZE): features of the path, then of the text."""
    if not blocks:
        return np.zeros((0, SIZE), np.float32)
    rows = []
    for b in blocks:
        text = b.text
        n = len(text)
        words_n = text.count(" ") + 1
        link = b.linked / max(1, sum(map(len, b.parts)))
        rows.append(
            (
                1,
                words_n < 4,
                4 <= words_n < 10,
                10 <= words_n < 25,
                words_n >= 25,
                link > 0.8,
                0.3 < link <= 0.8,
                link == 0,
                min(3, len(_MARKS.findall(text))) / 3,
                text[-1:] in ".!?…\"”",
                "©" in text or "copyright" in text.lower(),
                min(1, 4 * len(_DIGITS.findall(text)) / max(1, n)),
                "|" in text or "»" in text or "·" in text,
                text.isupper(),
                "@" in text or "http" in text,
                text[:1].islower(),
            )
        )
    return np.hstack([np.stack([_path_features(b.path) for b in blocks]), np.array(rows, np.float32)])


# --- the chain -------------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    """weights (SIZE, 2) per feature and label; change (2, 2) from label to label; begin (2)."""

    weights: np.ndarray
    change: np.ndarray
    begin: np.ndarray

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Viterbi: the best labels of a whole page."""
        if not len(x):
            return np.zeros(0, np.int8)
        (to00, to01), (to10, to11) = self.change.tolist()
        scores = (x @ self.weights).tolist()
        a, b = scores[0][0] + self.begin[0], scores[0][1] + self.begin[1]
        back = [(0, 0)]
        for s0, s1 in scores[1:]:
            from0, from1 = b + to10 > a + to00, b + to11 > a + to01
            back.append((from0, from1))
            a, b = (b + to10 if from0 else a + to00) + s0, (b + to11 if from1 else a + to01) + s1
        out = np.empty(len(x), np.int8)
        label = int(b > a)
        for i in range(len(x) - 1, -1, -1):
            out[i] = label
            label = int(back[i][label])
        return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def fit(pages: list[tuple[np.ndarray, np.ndarray]], steps: int = 120, rate: float = 0.15, decay: float = 2e-3) -> Chain:
    """Adam on the log-likelihood. Pages are padded to one length, so forward-backward runs over all of them at once."""
    n, longest = len(pages), max(len(x) for x, _ in pages)
    x = np.zeros((n, longest, SIZE), np.float32)
    y = np.zeros((n, longest), int)
    real = np.zeros((n, longest), bool)
    for i, (f, l) in enumerate(pages):
        x[i, : len(f)], y[i, : len(f)], real[i, : len(f)] = f, l, True
    gold = np.eye(2)[y] * real[:, :, None]
    both = real[:, 1:] & real[:, :-1]
    gold_change = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    p = [np.zeros((SIZE, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    for step in range(1, steps + 1):
        w, change, begin = p
        s = x @ w
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = s[:, 0] + begin
        for t in range(1, longest):
            new = s[:, t] + _log_sum(ahead[:, t - 1, :, None] + change, 1)
            ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            new = _log_sum(change + (s[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], new, 0)
        total = _log_sum(ahead[:, -1], 1)
        one = np.exp(ahead + behind - total[:, None, None]) * real[:, :, None]
        two = ahead[:, :-1, :, None] + change + (s[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        two = np.exp(np.where(both[:, :, None, None], two, -np.inf))
        grads = [
            np.einsum("ntf,nta->fa", x, gold - one) / n - decay * w,
            (gold_change - two.sum((0, 1))) / n - decay * change,
            (gold[:, 0] - one[:, 0]).sum(0) / n - decay * begin,
        ]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            p[i] = p[i] + rate * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Chain(*p)


# --- labelled pages ----------------------------------------------------------------


def labelled_pages(n: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    """Pages of many layouts with the label of every leaf block, 1 for main text.

    Layout, depth, class words, order and text lengths vary; words are letters
    at random, so only structure and form can be learned. Some articles lie in the
    body itself, and some pages are nothing but their text.
    """
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzàéöñ") for _ in range(rng.randint(1, 10)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    def sentence(low: int = 3, high: int = 22) -> str:
        text = words(low, high).capitalize()
        if rng.random() < 0.12:
            text = " ".join(w + rng.choice(["***", "###", "%%%", "!!"]) for w in text.split())
        if rng.random() < 0.08:  # numbers, codes and long tokens
            odd = ["".join(rng.choice("0123456789abcdef-") for _ in range(rng.randint(6, 40))), str(rng.randint(0, 10**9)), f"{rng.randint(1, 31)}.{rng.randint(1, 12)}.{rng.randint(1990, 2030)}"]
            text = " ".join(rng.choice(odd) if rng.random() < rng.choice([0.2, 0.9]) else w for w in text.split())
        return text + rng.choice([".", ".", ".", "!", "?", ""])

    def prose(low: int, high: int) -> str:
        return " ".join(sentence() for _ in range(rng.randint(low, high)))

    def open_tag(tag: str, *classes: str) -> str:
        if not classes or rng.random() < 0.25:
            return f"<{tag}>"
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{rng.choice(classes)}">'

    out = []
    for _ in range(n):
        html, labels = [], []

        def add(markup: str, label: int | None = None):
            html.append(markup)
            if label is not None:
                labels.append(label)

        def menu(tag: str, *classes: str):
            add(open_tag(tag, *classes) + "<ul>" * (flat := rng.random() < 0.7))
            for _ in range(rng.randint(2, 8)):
                add(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' if flat else f'<div><a href="/{word()}">{words(1, 3)}</a></div>', 0)
            add("</ul>" * flat + f"</{tag}>")

        def box(tag: str, classes: tuple[str, ...], always: bool = True):
            first = f'<{tag} class="{rng.choice(classes)}">' if always else open_tag(tag, *classes)
            shape = rng.random()
            if shape < 0.5:
                add(f"{first}{prose(1, 3)}</{tag}>", 0)
            elif shape < 0.8:
                add(f"{first}<p>{prose(1, 3)}</p>", 0)
                add(f"</{tag}>")
            else:
                add(f"{first}<h3>{words(1, 4)}</h3>", 0)
                for _ in range(rng.randint(1, 3)):
                    add(f"<p>{prose(1, 2)}</p>", 0)
                add(f"</{tag}>")

        def notices():
            if rng.random() < 0.4:
                box("div", ("ad", "ads", "advert", "advertisement", "sponsored", "promo banner", "ad banner"))
            if rng.random() < 0.2:
                box("div", ("cookie", "cookie notice", "consent", "alert notice", "newsletter", "popup", "subscribe"))

        def article():
            holder = rng.choice(["article", "article", "article", "article", "main", "main", "div", "div", "div", "section", "main article", "", ""])
            outer = holder.split()
            for tag in outer[:-1]:
                add(f"<{tag}>")
            tag = outer[-1] if outer else ""
            add("" if not outer else f"<{tag}>" if tag in ("article", "main") and rng.random() < 0.7 else f'<{tag} class="{rng.choice(("content", "post", "entry content", "story", "article body", "post text", "main content"))}">')
            if rng.random() < 0.85:
                add(f"<h1>{words(3, 12)}</h1>", 1)
            if rng.random() < 0.15:
                add(f'<p class="{rng.choice(("meta", "byline", "date author"))}">{words(1, 5)} {rng.randint(1, 30)}</p>', 0)
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6, 10, 16])):
                kind = rng.random()
                if kind < 0.55:
                    add(f"<p>{prose(1, 8)}" + "</p>" * (rng.random() < 0.8), 1)
                elif kind < 0.68:
                    add(f"<p><b>{prose(1, 4)}<br>" + f"{prose(1, 2)}" * (rng.random() < 0.4), 1)
                elif kind < 0.74:
                    add(f"<h2>{words(1, 8)}</h2>", 1)
                elif kind < 0.80:
                    add(f"<p>{words(1, 4)}{rng.choice(['.', ''])}</p>", 1)
                elif kind < 0.86:
                    add("<ul>")
                    for _ in range(rng.randint(2, 5)):
                        add(f"<li>{sentence(2, 14)}</li>", 1)
                    add("</ul>")
                elif kind < 0.90:
                    add(f"<blockquote>{prose(1, 3)}</blockquote>", 1)
                elif kind < 0.93:
                    add(f'<p>{prose(1, 3)} <a href="/{word()}">{words(1, 4)}</a> {prose(1, 2)}</p>', 1)
                elif kind < 0.96:
                    add(f"<pre>{words(3, 20)}</pre>", 1)
                else:
                    box("div", ("ad", "ads", "advert", "sponsored", "newsletter", "related", "share social"))
            add("".join(f"</{t}>" for t in reversed(outer)))

        if rng.random() < 0.03:  # text alone, or in paragraphs
            tag = rng.choice(["", "", "p", "div"])
            for _ in range(rng.randint(1, 4) if tag else 1):
                add(f"<{tag}>" * bool(tag) + prose(1, 4) + f"</{tag}>" * bool(tag), 1)
            out.append(("".join(html), labels))
            continue
        add(f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title><style>p{{}}</style></head><body>" if rng.random() < 0.95 else "")
        if rng.random() < 0.4:
            add(open_tag("header", "header", "page header"))
            add(f"<{rng.choice(['div', 'h2', 'p', 'a'])}>{words(1, 6)}", 0)
            add("</header>")
        if rng.random() < 0.85:
            menu(rng.choice(["nav", "nav", "nav", "div"]) if rng.random() < 0.7 else "nav", "menu", "navbar", "navigation")
        notices()
        if rng.random() < 0.15:
            menu("div", "breadcrumb", "breadcrumbs")
        sides = rng.random()
        if sides < 0.15:
            box("aside", ("sidebar", "side widget"), False)
        article()
        notices()
        if sides > 0.75:
            box("aside", ("sidebar", "side widget", "related"), False)
        if rng.random() < 0.15:
            menu("div", "related", "recommended", "share social", "pagination", "tags")
        if rng.random() < 0.25:
            add(f'<{(t := rng.choice(["section", "div"]))} class="{rng.choice(("comments", "comment respond", "disqus comments"))}">')
            add(f"<h3>{words(1, 3)}</h3>", 0)
            for _ in range(rng.randint(1, 4)):
                add(f'<div class="comment"><p>{prose(1, 4)}</p></div>', 0)
            add(f"</{t}>")
        if rng.random() < 0.1:
            add(f"<form><label>{words(1, 3)}</label><input></form>", 0)
        if rng.random() < 0.9:
            add(open_tag("footer", "footer"))
            for _ in range(rng.choice([1, 1, 2])):
                add(f"<{(t := rng.choice(['p', 'div', 'p']))}>" + rng.choice(["&copy; ", "&copy; ", "", "Copyright "]) + rng.choice(["", f"{word()}.com &middot; "]) + sentence(2, 14) + f"</{t}>", 0)
            add("</footer>")
        add("</body></html>")
        out.append(("".join(html), labels))
    return out


@functools.lru_cache(maxsize=2)
def trained(pages: int = 400, seed: int = 0) -> Chain:
    """The chain fitted on ``pages`` labelled pages."""
    made = [(blocks_of(html), labels) for html, labels in labelled_pages(pages, seed)]
    return fit([(features(b), np.array(l)) for b, l in made if b and len(b) == len(l)])


# --- Spark ----------------------------------------------------------------------


def main_text(html: str, chain: Chain) -> str:
    blocks = blocks_of(html)
    kept = chain.labels(features(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def extract(pages: DataFrame, chain: Chain, html: str = "html", text: str = "text", size: str = "n_chars") -> DataFrame:
    """``pages`` without ``html``, with the main text and its length in code points as last columns.

    Where a column has one of their names, theirs get an underscore before it.
    """
    text, size = spare_name(pages.drop(html), text), spare_name(pages.drop(html), size)

    @F.pandas_udf("string")
    def of_html(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, chain) if x else "" for x in batch], dtype=object)

    found = pages.withColumn(text, of_html(F.coalesce(F.col(html), F.lit("")))).drop(html)
    return found.withColumn(size, F.length(text).cast("long"))
