"""HTML extraction: linear-chain conditional random field over DOM leaf blocks, decoded by Viterbi.

A page is parsed into leaf blocks: runs of text between block-level boundaries, with the open ancestors. A block's
features are its ancestors' tags and class or id words, its own tag, and its text's length, link share and ending. Labels
are kept (the article) or not; weights are fitted by gradient on the likelihood of labelled pages (forward-backward),
which html_pages makes: `train_pages` of them, the documented bound of the training set. Kept blocks are joined in page
order. The work is a map over pages; the model is a small table of weights. The features of the open elements are
counted and their weights summed once, when an element opens, and taken back when it closes, so that a page takes time
and memory in proportion to its length, however deep its nesting.

Defined cases: null html counts as empty; a page without text or kept block gives an empty string; broken or unclosed
markup is closed where its parent ends; scripts, styles, comments and attributes are never text; references are decoded
once; white space (Unicode's) within a block is one space; repeated rows are extracted each; an empty table gives no row;
other columns are ignored; texts are whole.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table
from .html_pages import Maker

BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript object ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag that ends an open one of these, if that is the innermost block.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Leaf:
    """A block's text, the characters of it inside links, and of its ancestors the summed weights or (in training) the features."""

    __slots__ = ("text", "linked", "score", "names", "tag")

    def __init__(self, text: str, linked: int, score: float, names: list[str] | None, tag: str) -> None:
        self.text, self.linked, self.score, self.names, self.tag = text, linked, score, names, tag


class Leaves(HTMLParser):
    """Leaf blocks of a page. With weights, leaves have their ancestors' score; without, the ancestors' features."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.weights = weights
        self.leaves: list[Leaf] = []
        self.stack: list[tuple[str, list[str], float]] = []  # tag, features that it opened, score before it
        self.blocks: list[int] = []  # places of the block-level ones in stack
        self.opened: Counter = Counter()  # open elements of a tag
        self.active: set[str] = set()  # features of open elements
        self.score = 0.0
        self.parts: list[str] = []
        self.links = self.linked = self.hidden = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                tags = [self.stack[n][0] for n in self.blocks[-2:]]
                own = [f"tag:{tags[-1]}" if tags else "tag:", f"pair:{'>'.join(tags)}"]
                if not self.active & {"in:article", "in:main"}:
                    own.append("loose")
                if self.weights is None:
                    self.leaves.append(Leaf(text, self.linked, 0.0, sorted(self.active.union(own)), tags[-1] if tags else ""))
                else:
                    self.leaves.append(Leaf(text, self.linked, self.score + sum(self.weights.get(f, 0.0) for f in own), None, tags[-1] if tags else ""))
            self.parts = []
        self.linked = 0

    def push(self, tag: str, given: list[str]) -> None:
        new, before = [], self.score
        if tag in BLOCK:
            self.blocks.append(len(self.stack))
            new = [f for f in element_features(tag, given) if f not in self.active]
            self.active.update(new)
            if self.weights is not None:
                self.score += sum(self.weights.get(f, 0.0) for f in new)
        self.opened[tag] += 1
        self.stack.append((tag, new, before))

    def pop(self, n: int) -> None:
        while len(self.stack) > n:
            tag, new, self.score = self.stack.pop()
            self.active.difference_update(new)
            self.opened[tag] -= 1
            self.links -= tag == "a"
            self.hidden -= tag in ("script", "style", "svg")
        while self.blocks and self.blocks[-1] >= n:
            self.blocks.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.flush()
            ends = CLOSES.get(tag) or (CLOSES["p"] if tag in ("div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre", "form", "footer", "header", "nav", "aside", "figure", "hr") else ())
            while ends and self.blocks and self.stack[self.blocks[-1]][0] in ends:
                self.pop(self.blocks[-1])
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag == "a":
            self.links += 1
        elif tag in ("script", "style", "svg"):
            self.hidden += 1
        self.push(tag, [v for k, v in attrs if k in ("class", "id", "role", "aria-label") and v])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "svg"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.opened[tag]:
            # an inline element doesn't end a block
            for n in range(len(self.stack) - 1, self.blocks[-1] if tag not in BLOCK and self.blocks else -1, -1):
                if self.stack[n][0] == tag:
                    self.pop(n)
                    break
        elif tag == "br":
            self.parts.append(" ")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.links > 0:
                self.linked += len(data)


def leaves(html: str | None, weights: dict[str, float] | None = None) -> list[Leaf]:
    if not html:
        return []
    for text in (html, html.replace("<![", "&lt;![")):  # the library asserts on unknown marked sections
        p = Leaves(weights)
        try:
            p.feed(text)
            p.close()
            p.flush()
            return p.leaves
        except AssertionError:
            continue
    return p.leaves


def element_features(tag: str, given: list[str]) -> set[str]:
    """Features that an open block-level element gives to every block in it: its tag, and its names' words and word pairs."""
    out = {f"in:{tag}"} if tag not in ("html", "body") else set()
    if given:
        named = [w.lower() for w in WORD.findall(" ".join(given))]
        out |= {f"name:{w}" for w in named} | {f"names:{a}-{b}" for a, b in zip(named, named[1:])}
    return out


def text_features(leaf: Leaf) -> tuple[int, int, int, int]:
    n = len(leaf.text)
    return min(n, 1 << 12).bit_length(), min(4, 5 * leaf.linked // n), ".!?:;…。".find(leaf.text[-1]) >= 0, leaf.text[0] == "©" or leaf.text[:9].lower() == "copyright"


def names_of(t: tuple[int, int, int, int]) -> list[str]:
    return [f"long:{t[0]}", f"linked:{t[1]}", f"stop:{t[2]}", f"rights:{t[3]}", "bias"]


class Model:
    """Weights of features for 'kept' and of label changes; (start, change, end) scores."""

    def __init__(self, weights: dict[str, float], start: np.ndarray, change: np.ndarray) -> None:
        self.weights, self.start, self.change = weights, start.tolist(), change.tolist()
        self.texts: dict = {}  # a bounded number of keys

    def of_text(self, leaf: Leaf) -> float:
        key = text_features(leaf)
        v = self.texts.get(key)
        if v is None:
            v = self.texts[key] = sum(self.weights.get(f, 0.0) for f in names_of(key))
        return v

    def decode(self, blocks: list[Leaf]) -> list[int]:
        """Best labels by Viterbi."""
        if not blocks:
            return []
        (a, b), (c, d) = self.change
        s0 = s1 = 0.0
        back = []
        for i, leaf in enumerate(blocks):
            e = leaf.score + self.of_text(leaf)
            if i == 0:
                s0, s1 = self.start[0], self.start[1] + e
                continue
            back.append((0 if s0 + a >= s1 + c else 1, 0 if s0 + b >= s1 + d else 1))
            s0, s1 = max(s0 + a, s1 + c), max(s0 + b, s1 + d) + e
        y = [int(s1 > s0)]
        for step in reversed(back):
            y.append(step[y[-1]])
        return y[::-1]

    def extract(self, html: str | None) -> str:
        blocks = leaves(html, self.weights)
        return " ".join(x.text for x, y in zip(blocks, self.decode(blocks)) if y)


@functools.cache
def trained(train_pages: int = 800, seed: int = 5, steps: int = 150, l2: float = 0.05) -> Model:
    maker, pages, labels = Maker(seed), [], []
    for _ in range(train_pages):
        html, kept = maker.page()
        blocks, texts = leaves(html), {" ".join(t.split()) for t in kept}
        pages.append([b.names + names_of(text_features(b)) for b in blocks])
        labels.append([int(b.text in texts and b.tag != "title") for b in blocks])
    index = {f: i for i, f in enumerate(sorted({f for p in pages for b in p for f in b}))}
    n, t = len(pages), max(map(len, pages))
    at = np.array([(i * t + j, index[f]) for i, p in enumerate(pages) for j, b in enumerate(p) for f in b])
    y, on = np.zeros((n, t), int), np.zeros((n, t), bool)
    for i, row in enumerate(labels):
        y[i, : len(row)], on[i, : len(row)] = row, True
    w, start, change = np.zeros(len(index)), np.zeros(2), np.zeros((2, 2))
    seen = [np.full(v.shape, 1e-6) for v in (w, start, change)]
    real_start = np.bincount(y[:, 0], minlength=2).astype(float)
    pairs = on[:, 1:]
    real_change = np.zeros((2, 2))
    np.add.at(real_change, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    for _ in range(steps):
        e = np.zeros((n, t, 2))
        e[..., 1] = np.bincount(at[:, 0], w[at[:, 1]], n * t).reshape(n, t)
        f, b = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        f[:, 0] = start + e[:, 0]
        for j in range(1, t):
            step = np.logaddexp.reduce(f[:, j - 1, :, None] + change, axis=1) + e[:, j]
            f[:, j] = np.where(on[:, j, None], step, f[:, j - 1])
        for j in range(t - 2, -1, -1):
            step = np.logaddexp.reduce(change + (e[:, j + 1] + b[:, j + 1])[:, None, :], axis=2)
            b[:, j] = np.where(on[:, j + 1, None], step, 0)
        z = np.logaddexp.reduce(f[:, -1], axis=1)
        p = np.exp(f + b - z[:, None, None])[..., 1] * on
        gw = np.bincount(at[:, 1], (p - y * on).reshape(-1)[at[:, 0]], len(index)) + l2 * w
        p0 = np.exp(f[:, 0] + b[:, 0] - z[:, None]).sum(axis=0)
        q = np.exp(f[:, :-1, :, None] + change + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[..., None, None]
        for v, s, g in zip((w, start, change), seen, (gw, p0 - real_start + l2 * start, q.sum(axis=(0, 1)) - real_change + l2 * change)):
            s += g * g
            v -= 0.3 * g / np.sqrt(s)
    return Model({f: float(w[i]) for f, i in index.items()}, start, change)


def main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), train_pages: int = 800) -> DataFrame:
    """The columns of `keep`, text and n_chars of every page."""
    small_batches(pages.sparkSession)
    model = trained(train_pages)
    weights, start, change = model.weights, np.array(model.start), np.array(model.change)
    d = pages.select(F.col(html_col).cast("string").alias("_lm_html"), *[F.col(c).alias(f"_lm_{i}") for i, c in enumerate(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(weights, start, change)
        for b in batches:
            texts = [m.extract(h.as_py()) for h in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*b.schema.names[1:], "text", "n_chars"])

    out = d.mapInArrow(run, ", ".join([*(f"{c} {t}" for c, t in d.dtypes[1:]), "text string", "n_chars long"]))
    return out.select(*[F.col(f"_lm_{i}").alias(c) for i, c in enumerate(keep)], "text", "n_chars")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {"op7_html": op7_html}
SQL: dict[str, str] = {}
