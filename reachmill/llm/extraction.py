"""Main text of web pages by a tree-structured graphical model.

The page becomes its tree of block elements. Every element is a binary variable: does its
own text belong to the main text? Features of the element (its name, what its class, id
and role say, length and link share of its text) give one potential, and each pair of
parent and child has a potential of its own. Messages passed up from the leaves and down
from the root give every element's exact marginal, for all pages of a batch level by
level. The weights are fitted by gradient ascent on the likelihood of labelled pages,
whose gradient needs the same marginals.

An element's text is kept when its marginal is above one half. White space inside a block
becomes one space, blocks are trimmed and joined in page order by two line feeds. Scripts,
styles, comments of the markup, controls, inert templates, foreign frames, drawings and
the page's head are never text. A head that is left open ends where a browser ends it: at
the body, at an element that cannot stand in a head, or at text of its own. Formulas belong
to the text around them; what objects, media and noscript hold is an element like others.

Defined cases: a null or empty page, or one without main text, gives an empty text; torn
pages are read as far as they go; repeated rows give equal results; other columns are not
read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from reachmill.llm.labelled_pages import labelled_pages

#: Elements of the markup language by what they do to text.
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("head title script style template button select option textarea iframe svg".split())
#: What may stand in a head.
IN_HEAD = set("html head base basefont bgsound link meta title script style template noscript noframes".split())
#: Formulas, which run on in their line.
FORMULA = set("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced maction msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd semantics annotation annotation-xml".split())
INLINE |= FORMULA
#: Elements whose content the model judges by itself, but which part no text by standing in it.
FALLBACK = set("noscript object canvas audio video param source track".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd td th tr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
HOLDS_SIBLINGS = set("ul ol dl menu table tbody thead tfoot".split())
#: Words in names that tell a part of the page.
NAMES = {
    "text": "article content main post entry story body text",
    "menu": "nav menu navbar breadcrumb breadcrumbs topnav navigation toc",
    "header": "header masthead branding top topbar",
    "footer": "footer colophon bottom copyright legal contentinfo",
    "side": "sidebar aside widget related rail trending recommended complementary",
    "notice": "cookie cookies consent gdpr alert notice popup privacy modal",
    "advert": "ad ads advert adverts advertisement sponsored sponsor promo banner",
    "form": "newsletter subscribe login search signup form",
    "comments": "comment comments discussion reply replies responses disqus",
    "share": "share social follow sharing",
}
_GROUP = {word: group for group, words in NAMES.items() for word in words.split()}
_WORD = re.compile(r"[a-z]+")
_BLANK = re.compile(r"\s+")
_SECTIONS = ("article", "main", "nav", "header", "footer", "aside", "form", "section")


class _Tree(HTMLParser):
    """Block elements in page order and the texts between their boundaries."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names, self.main = [-1], ["#page"], [()], [None]
        self.blocks: list[list] = []  # element, pieces of text, characters inside links
        self.open: list[tuple[str, int]] = []
        # what is looked up at every tag is kept, as a page may be as deep as it is long
        self.blocks_open: list[int] = []  # the open block elements
        self.times_open: Counter[str] = Counter()
        self.head = -1  # where in open a head stands
        self._push("#page", 0)
        self.silent, self.links, self.fresh = 0, 0, True

    def _push(self, tag: str, element: int) -> None:
        """Open an element; those that are no blocks have the number -1."""
        if tag == "head" and self.head < 0:
            self.head = len(self.open)
        self.open.append((tag, element))
        self.times_open[tag] += 1
        if element >= 0:
            self.blocks_open.append(element)

    def _end_head(self, everything: bool = False) -> None:
        """Close a head that is open; not from inside its title, scripts, styles or templates,
        unless everything in it ends."""
        if self.head >= 0 and (everything or all(name == "noscript" for name, _ in self.open[self.head + 1 :])):
            self._close("head", stop=())

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body" or tag not in IN_HEAD:
            self._end_head(everything=tag == "body")
        if tag in INLINE:
            if tag == "br":
                self.handle_data(" ")
            elif tag not in VOID:
                self._push(tag, -1)
                self.links += tag == "a"
            return
        if tag in SILENT:
            # what is not shown does not part the text around it
            if tag not in VOID:
                self._push(tag, -1)
                self.silent += 1
            return
        self.fresh |= tag not in FALLBACK
        if tag in CLOSES_P:
            self._close("p", stop=CLOSES_P - {"p"} | {"object"})
        for sibling in SIBLINGS.get(tag, ()):
            self._close(sibling, stop=HOLDS_SIBLINGS | ({"tr"} if tag in ("td", "th") else set()))
        if tag in VOID:
            return
        attributes = dict(attrs)
        told = " ".join(attributes.get(a) or "" for a in ("class", "id", "role")).lower()
        self.parent.append(self.blocks_open[-1])
        self.tag.append(tag)
        self.names.append(tuple(sorted({_GROUP[w] for w in _WORD.findall(told) if w in _GROUP})))
        self.main.append(attributes.get("data-main"))
        self._push(tag, len(self.tag) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE and tag not in SILENT and tag not in FALLBACK:
            self.fresh = True
        self._close(tag, stop=() if tag not in INLINE else CLOSES_P)

    def _close(self, tag: str, stop) -> None:
        """Close the nearest open element of that name, with all inside; not beyond stop."""
        if not self.times_open[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name == tag:
                for gone, element in self.open[at:]:
                    self.silent -= gone in SILENT
                    self.links -= gone == "a"
                    self.times_open[gone] -= 1
                    if element >= 0:
                        self.blocks_open.pop()
                del self.open[at:]
                self.head = -1 if self.head >= at else self.head
                return
            if name in stop:
                return

    def handle_data(self, data: str) -> None:
        if self.silent and not data.isspace():
            self._end_head()
        if self.silent or not data:
            return
        element = self.blocks_open[-1]
        if self.fresh or not self.blocks or self.blocks[-1][0] != element:
            self.blocks.append([element, [], 0])
            self.fresh = False
        self.blocks[-1][1].append(data)
        if self.links > 0:
            self.blocks[-1][2] += len(data.strip())


def _parse(html: str) -> _Tree:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree


@dataclass
class Forest:
    """The trees of some pages, their elements numbered through. Parents come first."""

    parent: np.ndarray
    depth: np.ndarray
    features: list[list[int]]
    label: np.ndarray
    texts: list[list[tuple[int, str]]]  # per page: element and block, in page order


@lru_cache(maxsize=4096)
def _number(name: str) -> int:
    """A feature's place in the weights."""
    import zlib

    return zlib.crc32(name.encode()) % 4093


def forest(pages: list[str | None]) -> Forest:
    parent: list[int] = []
    depth: list[int] = []
    features: list[list[int]] = []
    label: list[int] = []
    texts: list[list[tuple[int, str]]] = []
    for html in pages:
        tree = _parse(html) if html else _Tree()
        base, n = len(parent), len(tree.tag)
        length, linked, last = [0] * n, [0] * n, [""] * n
        found = []
        for element, parts, in_links in tree.blocks:
            text = _BLANK.sub(" ", "".join(parts)).strip()
            if text:
                found.append((base + element, text))
                length[element] += len(text)
                linked[element] += min(in_links, len(text))
                last[element] = text[-1]
        texts.append(found)
        below, below_linked = list(length), list(linked)
        for i in range(n - 1, 0, -1):
            below[tree.parent[i]] += below[i]
            below_linked[tree.parent[i]] += below_linked[i]
        section, main, here = [""] * n, [0] * n, [0] * n
        for i in range(n):
            p, tag = tree.parent[i], tree.tag[i]
            here[i] = here[p] + 1 if i else 0
            main[i] = int(tree.main[i]) if tree.main[i] in ("0", "1") else (main[p] if i else 0)
            section[i] = tag if tag in _SECTIONS else (section[p] if i else "")
            share = 0 if not below[i] else int(4 * below_linked[i] / below[i] + 0.5)
            size = min(7, below[i].bit_length() // 2)
            named = [f"name:{g}" for g in tree.names[i]] or ["unnamed"]
            own = f"own:{min(5, length[i].bit_length() // 2)}"
            ends = "ends:" + ("stop" if last[i] in ".!?…\"'" and last[i] else "none" if not last[i] else "other")
            features.append([_number(f) for f in ("all", f"tag:{tag}", f"in:{section[i]}", f"links:{share}", f"size:{size}", own, ends, *named)])
        parent.extend(base + p if i else -1 for i, p in enumerate(tree.parent))
        depth.extend(here)
        # an element without text of its own is main if something in it is
        for i in range(n - 1, -1, -1):
            main[i] = main[i] if length[i] else 0
        for i in range(n - 1, 0, -1):
            if not length[tree.parent[i]]:
                main[tree.parent[i]] |= main[i]
        label.extend(main)
    return Forest(np.array(parent, dtype=np.int64), np.array(depth, dtype=np.int64), features, np.array(label, dtype=np.int64), texts)


@dataclass
class Model:
    """unary: weight of each feature for main text; pair[p, c]: potential of parent and child."""

    unary: np.ndarray
    pair: np.ndarray


def _scores(trees: Forest, unary: np.ndarray) -> np.ndarray:
    sizes = np.fromiter(map(len, trees.features), dtype=np.int64, count=len(trees.features))
    flat = np.fromiter((f for fs in trees.features for f in fs), dtype=np.int64, count=int(sizes.sum()))
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=unary[flat], minlength=len(sizes))


def marginals(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Chance of main text for every element, and for every element but the roots the joint
    chances with its parent ([element, parent's value, own value]). Messages are log odds."""
    n = len(trees.parent)
    pair = model.pair
    odds = _scores(trees, model.unary)  # own potential and the messages from below
    up = np.zeros(n)
    # the elements of each depth, in order
    levels = np.split(np.argsort(trees.depth, kind="stable"), np.cumsum(np.bincount(trees.depth, minlength=1))[:-1])

    def sent(given: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Message over an edge from a variable with these log odds; table[to, from]."""
        return np.logaddexp(table[1, 1] + given, table[1, 0]) - np.logaddexp(table[0, 1] + given, table[0, 0])

    for level in reversed(levels[1:]):
        up[level] = sent(odds[level], pair)
        np.add.at(odds, trees.parent[level], up[level])
    joint = np.zeros((n, 2, 2))
    for level in levels[1:]:
        above = trees.parent[level]
        outside = odds[above] - up[level]  # the parent without this child
        table = pair[None] + np.array([0.0, 1.0])[None, :, None] * outside[:, None, None] + np.array([0.0, 1.0])[None, None, :] * odds[level][:, None, None]
        table = np.exp(table - table.max(axis=(1, 2), keepdims=True))
        joint[level] = table / table.sum(axis=(1, 2), keepdims=True)
        odds[level] += sent(outside, pair.T)
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500))), joint


def train(pages: list[str], steps: int = 150, rate: float = 0.5, decay: float = 1e-3) -> Model:
    """Gradient ascent on the likelihood of the labels, with adaptive step lengths."""
    trees = forest(pages)
    sizes = np.array([len(f) for f in trees.features])
    flat = np.concatenate([np.array(f) for f in trees.features])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    child = np.flatnonzero(trees.parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (trees.label[trees.parent[child]], trees.label[child]), 1)
    model = Model(np.zeros(4093), np.zeros((2, 2)))
    past_unary, past_pair = np.full(4093, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(steps):
        chance, joint = marginals(trees, model)
        slope = np.bincount(flat, weights=(trees.label - chance)[owner], minlength=4093) / len(pages) - decay * model.unary
        slope_pair = (seen - joint[child].sum(axis=0)) / len(pages) - decay * model.pair
        past_unary += slope**2
        past_pair += slope_pair**2
        model = Model(model.unary + rate * slope / np.sqrt(past_unary), model.pair + rate * slope_pair / np.sqrt(past_pair))
    return model


def default_model(n_pages: int = 400, seed: int = 0) -> Model:
    """Trained on generated labelled pages; the same on every run."""
    return train(labelled_pages(n_pages, seed))


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    trees = forest(pages)
    chance, _ = marginals(trees, model)
    return ["\n\n".join(text for element, text in page if chance[element] > 0.5) for page in trees.texts]


def main_text(html: Column, model: Model) -> Column:
    """The main text of every whole page."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        found: list[str] = []
        for begin in range(0, len(pages), 500):
            found += main_texts(pages.slice(begin, 500).to_pylist(), model)
        return pa.array(found, pa.string())

    return run(html)
