"""Main text of web pages: a recurrent labeller over the page's blocks.

A page becomes the sequence of its leaf blocks. Each block is read as hashed
vectors of its tag path (tags, classes, ids) and of its words, with a few counts;
a bidirectional LSTM in numpy labels every block with the whole page as context.
The network is trained on the driver on made-up pages of many layouts (the
number of pages bounds the training set) and its weights, a few hundred kB, go
to the tasks with the function.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, COUNTS, HIDDEN = 256, 24, 10, 20
INPUT = PATH_DIM + WORD_DIM + COUNTS
#: Blocks (with padding) that one pass of the network holds.
CELLS = 8192

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">]++)*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Fixed values of HTML: elements without content, whose content is no markup,
#: and that begin a block.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg".split())
BLOCK = frozenset(
    "html head title body main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre form fieldset figure figcaption address details summary select option button hr center dialog caption legend".split())
_CLOSES_P = BLOCK - {"option", "button"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Node:
    """An open block element: its label, its parent, how deep it stands, and the sum
    of what its path puts into the input vector. Paths share their ancestors, so a
    page's memory grows with its length, however deep it nests."""

    label: str
    parent: Node | None
    depth: int
    sum: np.ndarray

    def under(self, label: str) -> Node:
        total = self.sum.copy()
        for spot, weight in _label_spots(label):
            total[spot] += weight
        return Node(label, self, self.depth + 1, total)

    def path(self) -> tuple[str, ...]:
        """The labels from the page's root to this element."""
        labels, node = [], self
        while node.parent is not None:
            labels.append(node.label)
            node = node.parent
        return tuple(reversed(labels))


@dataclass
class Block:
    node: Node
    text: str
    linked: int = 0  # characters inside links


def _root() -> Node:
    return Node("", None, 0, np.zeros(PATH_DIM))


@dataclass
class _Reader:
    """Collects blocks while the tokens of a page pass by. ``levels`` has the places
    of the open block elements in the stack, ``known`` counts the open elements: of
    block tags by tag, of others by tag and level, so that an end tag without its
    element costs no search."""

    stack: list[tuple[str, Node]] = field(default_factory=list)  # tag, innermost block element
    levels: list[int] = field(default_factory=list)
    known: Counter = field(default_factory=Counter)
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: int = 0
    root: Node = field(default_factory=_root)

    def here(self) -> Node:
        return self.stack[-1][1] if self.stack else self.root

    def key(self, tag: str) -> str | tuple[str, int]:
        return tag if tag in BLOCK else (tag, len(self.levels))

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(self.here(), text, self.links))
        self.parts, self.links = [], 0

    def cut(self, place: int) -> None:
        """Close the elements from ``place`` on."""
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            if tag in BLOCK:
                self.levels.pop()
            self.known[self.key(tag)] -= 1

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            gone = _SIBLINGS.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
            if self.levels and self.stack[self.levels[-1]][0] in gone:
                self.cut(self.levels[-1])
        elif tag == "br":
            self.parts.append(" ")
        if tag not in VOID and not attributes.endswith("/") or tag in BLOCK and tag not in VOID:
            self.known[self.key(tag)] += 1
            node = self.here()
            if tag in BLOCK:
                names = " ".join(next(filter(None, m), "") for m in _NAMES.findall(attributes)) if attributes else ""
                node = node.under(f"{tag} {names.lower()}" if names else tag)
                self.levels.append(len(self.stack))
            self.stack.append((tag, node))

    def close(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.known[self.key(tag)] > 0:
            place = len(self.stack) - 1
            while self.stack[place][0] != tag:
                place -= 1
            self.cut(place)

    def text(self, piece: str) -> None:
        piece = entities.unescape(piece)
        self.parts.append(piece)
        if any(tag == "a" for tag, _ in self.stack[-4:]):
            self.links += len(piece.strip())


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order: comments, declarations and the content
    of scripts and styles left out, character references decoded, blanks
    collapsed to one space. Broken markup is read as far as it goes."""
    reader, at = _Reader(), 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if tag:
            if m[1] or m[4]:
                reader.close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                reader.open(tag, m[3] or m[6] or "")
        elif page[m.start()] != "<" or at - m.start() == 1:
            reader.text(m[0])
        elif m[0].startswith("<![CDATA["):
            reader.text(m[0][9:].removesuffix("]]>"))
    reader.flush()
    return reader.blocks


def _spot(text: str, dim: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % dim


@functools.lru_cache(maxsize=65536)
def _label_spots(label: str) -> tuple[tuple[int, float], ...]:
    """What an element of a path adds to the vector: its tag and its names, each of
    them in three places, so that a name which meets another in one differs in the rest."""
    tag, _, names = label.partition(" ")
    return ((_spot(tag, PATH_DIM), 0.5), *((_spot(mark + name, PATH_DIM), 0.7) for name in re.findall("[a-z]+", names) for mark in ".:;"))


def _path_vector(node: Node) -> np.ndarray:
    """The path's sum, in which the four innermost tags count double."""
    v, inner = node.sum.copy(), node
    for _ in range(min(4, node.depth)):
        spot, weight = _label_spots(inner.label)[0]
        v[spot] += weight
        inner = inner.parent
    return v / np.sqrt(node.depth + 1)


def vectors(blocks: list[Block]) -> np.ndarray:
    """One input row per block; every word of a block counts."""
    out = np.zeros((len(blocks), INPUT))
    n = len(blocks)
    for i, b in enumerate(blocks):
        words = b.text.split(" ")
        out[i, :PATH_DIM] = _path_vector(b.node)
        spots = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) % WORD_DIM for w in words), np.int64, len(words))
        out[i, PATH_DIM:PATH_DIM + WORD_DIM] = np.bincount(spots, minlength=WORD_DIM) / (len(words) + 8)
        size = len(b.text)
        out[i, PATH_DIM + WORD_DIM:] = (
            np.log1p(size) / 6, np.log1p(len(words)) / 4, b.linked / size, b.text[-1] in ".!?…\"'", "," in b.text,
            sum(map(str.isdigit, b.text)) / size, min(b.node.depth, 64) / 8, i / n, 1 / (i + 1), 1 / (n - i))
    return out


@dataclass
class Network:
    """Weights of the two directions (input, recurrent, bias) and of the output."""

    sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    top: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [a for side in self.sides for a in side] + [self.top, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _walk(x: np.ndarray, mask: np.ndarray, side: tuple, keep: list | None = None) -> np.ndarray:
    """Hidden states (pages, steps, HIDDEN) of one direction over padded pages;
    a masked step carries the state on."""
    w, u, b = side
    n, steps, _ = x.shape
    gates = x @ w + b
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out = np.empty((n, steps, HIDDEN))
    for t in range(steps):
        z = gates[:, t] + h @ u
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        new_c = np.where(m, f * c + i * g, c)
        new_h = np.where(m, o * np.tanh(new_c), h)
        if keep is not None:
            keep.append((h, c, i, f, o, g, new_c, m))
        h, c = new_h, new_c
        out[:, t] = h
    return out


def _back(x: np.ndarray, side: tuple, kept: list, grad: np.ndarray) -> list[np.ndarray]:
    """Gradients of one direction's weights, through time."""
    w, u, _ = side
    dw, du, db = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * HIDDEN)
    dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
    for t in range(x.shape[1] - 1, -1, -1):
        h, c, i, f, o, g, new_c, m = kept[t]
        dh = dh + grad[:, t]
        tanh = np.tanh(new_c)
        step = dc + dh * o * (1 - tanh ** 2)
        dz = np.concatenate([step * g * i * (1 - i), step * c * f * (1 - f), dh * tanh * o * (1 - o), step * i * (1 - g ** 2)], axis=1) * m
        dw += x[:, t].T @ dz
        du += h.T @ dz
        db += dz.sum(axis=0)
        dc = np.where(m, step * f, dc)
        dh = np.where(m, dz @ u.T, dh)
    return [dw, du, db]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, INPUT)), np.zeros((len(pages), steps), dtype=bool)
    for k, rows in enumerate(pages):
        x[k, :len(rows)], mask[k, :len(rows)] = rows, True
    return x, mask


def probabilities(net: Network, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of each block of each page to be main text. Pages of like
    length go through the network together."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
    while order:
        n = max(1, min(len(order), CELLS // len(pages[order[0]])))
        while n > 1 and n * len(pages[order[n - 1]]) > 2 * CELLS:
            n //= 2
        group, order = order[:n], order[n:]
        x, mask = _padded([pages[i] for i in group])
        h = np.concatenate([_walk(x, mask, net.sides[0]), _walk(x[:, ::-1], mask[:, ::-1], net.sides[1])[:, ::-1]], axis=2)
        p = _sigmoid(h @ net.top + net.bias)
        for k, i in enumerate(group):
            out[i] = p[k, :len(pages[i])]
    return out


def _train(pages: list[np.ndarray], labels: list[np.ndarray], epochs: int, seed: int) -> Network:
    """Weights by Adam on the blocks' log-loss."""
    rng = np.random.default_rng(seed)
    make = lambda rows, cols: rng.normal(size=(rows, cols)) / np.sqrt(rows)
    start = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    net = Network([(make(INPUT, 4 * HIDDEN), make(HIDDEN, 4 * HIDDEN), start.copy()) for _ in range(2)],
                  rng.normal(size=2 * HIDDEN) / 4, np.zeros(1))
    params = net.arrays()
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    batches = [order[i:i + 32] for i in range(0, len(order), 32)]
    for epoch in range(epochs):
        for b in rng.permutation(len(batches)):
            group = batches[b]
            x, mask = _padded([pages[i] for i in group])
            y = np.zeros(mask.shape)
            for k, i in enumerate(group):
                y[k, :len(labels[i])] = labels[i]
            kept: tuple[list, list] = ([], [])
            h = np.concatenate([_walk(x, mask, net.sides[0], kept[0]), _walk(x[:, ::-1], mask[:, ::-1], net.sides[1], kept[1])[:, ::-1]], axis=2)
            error = (_sigmoid(h @ net.top + net.bias) - y) * mask / mask.sum()
            dh = error[:, :, None] * net.top
            grads = _back(x, net.sides[0], kept[0], dh[:, :, :HIDDEN]) + _back(x[:, ::-1], net.sides[1], kept[1], dh[:, ::-1, HIDDEN:])
            grads += [np.einsum("nt,nth->h", error, h), np.array([error.sum()])]
            step += 1
            rate = 0.02 * (1 - epoch / epochs) + 0.002
            for p, g, a, v in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                v += 0.01 * (g * g - v)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def _made_page(rng: random.Random) -> tuple[str, list[bool]]:
    """A made-up page and, for each of its blocks, whether it is main text."""
    letters = "abcdefghijklmnopqrstuvwxyzäéñü"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
    mark = rng.choice(["", "", "", "%%%", "###", "***"])
    words = lambda a, b: " ".join(word() + (mark if rng.random() < 0.7 else "") for _ in range(rng.randint(a, b)))
    line = lambda a, b: words(a, b).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])
    out: list[str] = []
    truth: list[bool] = []

    def put(markup: str, main: bool, n: int = 1) -> None:
        out.append(markup)
        truth.extend([main] * n)

    def menu(open_: str, close: str) -> None:
        n = rng.randint(1, 9)
        style = rng.random()
        if style < 0.6:
            put(open_ + "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n)) + "</ul>" + close, False, n)
        else:
            put(open_ + " ".join(f'<a href="#">{words(1, 2)}</a>' for _ in range(n)) + close, False)

    def named(tag: str, names: list[str]) -> tuple[str, str]:
        kind = rng.choice(["class", "class", "id"])
        return f'<{tag} {kind}="{rng.choice(names)}">', f"</{tag}>"

    menus = ["menu", "nav", "navbar", "breadcrumb", "top-menu", "navigation", "links", "toc"]
    sides = ["sidebar", "side", "widget", "related", "promo", "recommended", "share", "social", "tags", "popular"]
    notes = ["cookie", "notice", "banner", "alert", "consent", "popup", "newsletter", "subscribe", "modal", "disclaimer"]
    adverts = ["ad", "ads", "advert", "sponsored", "advertisement", "ad-box", "sponsor"]
    talk = ["comments", "comment-list", "discussion", "replies", "responses", "comment", "reply"]
    mains = ["content", "post", "entry", "story", "article-body", "post-content", "main-text", "text", "body-text", "article"]

    def noise(inside: bool) -> None:
        pick = rng.random()
        if pick < 0.3:
            a, b = named(rng.choice(["div", "div", "section", "aside", "p"]), adverts)
            put(a + line(2, 25) + b, False)
        elif pick < 0.5:
            a, b = rng.choice([named("div", sides), named("aside", sides), ("<aside>", "</aside>")])
            put(a + f"<h3>{words(1, 4)}</h3><p>{line(3, 30)}</p>" + b, False, 2) if rng.random() < 0.5 else put(a + line(3, 30) + b, False)
        elif pick < 0.65:
            a, b = named(rng.choice(["div", "section", "p"]), notes)
            put(a + line(4, 25) + b, False)
        elif pick < 0.8:
            put(f"<form action=\"/x\"><label>{words(1, 3)}</label><input name=\"q\"><button>{words(1, 2)}</button></form>", False, 2)
        elif not inside:
            menu(*rng.choice([("<nav>", "</nav>"), named("div", menus), named("ul", menus)]))
        else:
            a, b = named("div", sides)
            put(a + f'<a href="#">{words(2, 6)}</a>' + b, False)

    plain = ["container", "row", "col", "col-md-8", "wrap", "wrapper", "inner", "page", "grid", "box", "column", "block", "section", "center", "site", "layout"]

    def neutral() -> tuple[str, str]:
        """A container whose name says nothing about its content."""
        pick = rng.random()
        if pick < 0.25:
            return "<div>", "</div>"
        if pick < 0.5:
            return named("div", plain)
        return f'<div class="{"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))}">', "</div>"

    def cells(rows: int, cols: int, head: bool) -> str:
        made = [[words(1, 3) if rng.random() < 0.6 else str(rng.randint(0, 9999)) for _ in range(cols)] for _ in range(rows)]
        return "<table>" + "".join("<tr>" + "".join(f"<{'th' if head and not i else 'td'}>{c}</{'th' if head and not i else 'td'}>" for c in row) + "</tr>"
                                   for i, row in enumerate(made)) + "</table>"

    def rich(main: bool) -> None:
        """Subheads, data tables, code, definition lists, captions: main text or not
        by where they stand."""
        pick = rng.random()
        if pick < 0.4:
            put(f"<h{rng.randint(3, 6)}>{words(1, 8)}", main)
            out.append("</h3>")
        elif pick < 0.55:
            rows, cols = rng.randint(1, 4), rng.randint(1, 4)
            put(cells(rows, cols, rng.random() < 0.6), main, rows * cols)
        elif pick < 0.7:
            put("<pre>" + "\n".join(f"{word()} = {word()}({rng.randint(0, 99)});" for _ in range(rng.randint(1, 5))) + "</pre>", main)
        elif pick < 0.85:
            n = rng.randint(1, 3)
            put("<dl>" + "".join(f"<dt>{words(1, 3)}</dt><dd>{line(2, 15)}</dd>" for _ in range(n)) + "</dl>", main, 2 * n)
        else:
            put(f'<figure><img src="x.png"><figcaption>{line(2, 12)}</figcaption></figure>', main)

    open_layout = rng.random() < 0.55
    wraps = [neutral() for _ in range(rng.choice([0, 1, 1, 2, 3]))] if open_layout or rng.random() < 0.2 else []
    table = open_layout and rng.random() < 0.25

    def links() -> None:
        """A menu that only its links show to be one."""
        n = rng.randint(2, 8)
        x, y = neutral()
        if rng.random() < 0.5:
            put(x + rng.choice([" ", " | ", " &middot; "]).join(f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(n)) + y, False)
        else:
            put(x + "<ul>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n)) + "</ul>" + y, False, n)

    put(f"<title>{words(2, 9)}</title>", False)
    out.append('<style>p{margin:0}</style><script>var t="</p>";</script></head><body>')
    out.extend(x for x, _ in wraps)
    if rng.random() < 0.3:
        a, b = named("div", notes)
        put(a + f"<p>{line(4, 20)}</p>" + b, False)
    if rng.random() < 0.5:
        a, b = rng.choice([("<header>", "</header>"), named("div", ["header", "masthead", "top", "site-header"])])
        put(a + rng.choice([f"<h1>{words(1, 4)}</h1>", f"<div class=\"logo\">{words(1, 3)}</div>", f"<p>{line(2, 9)}</p>"]) + b, False)
    if table:
        out.append("<table><tr><td>")
        links()
        out.append("</td><td>")
    elif rng.random() < 0.8:
        links() if open_layout and rng.random() < 0.5 else menu(*rng.choice([("<nav>", "</nav>"), ("<nav>", "</nav>"), named("div", menus)]))
    for _ in range(rng.choice([0, 1, 1, 2])):
        noise(False)
    if table:
        a, b = rng.choice([("", ""), neutral()])
    elif open_layout:
        steps = [neutral() for _ in range(rng.randint(1, 3))]
        a, b = "".join(x for x, _ in steps), "".join(y for _, y in steps)
    else:
        a, b = rng.choice([("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                           named("div", mains), named("article", mains), named("section", mains)])
    out.append(a)
    if rng.random() < 0.85:
        put(f"<h1>{line(1, 12)}</h1>", True)
    bare = rng.random() < (0.5 if open_layout else 0.2)  # paragraphs are elements that mean nothing
    for _ in range(rng.choice([2, 3, 4, 5, 6, 8, 14] if open_layout else [0, 1, 1, 2, 3, 5, 8, 14])):
        pick = rng.random()
        x, y = neutral() if bare else ("<p>", "</p>")
        if pick < 0.38:
            put(f"{x}{line(4 if open_layout else 1, 90)}{y}", True)
        elif pick < 0.5:
            put(f"{x}{line(4, 30)}{y}" if open_layout else f"<p>{line(1, 3)}</p>", True)
        elif pick < 0.62:
            put(f"<p><b>{line(4 if open_layout else 1, 40)}<br>", True)
        elif pick < 0.74:
            level = rng.choice([2, 2, 3, 3, 4, 5, 6])
            put(f"<h{level}>{words(1, 8)}</h{level}>", True)
        elif pick < 0.78:
            n = rng.randint(1, 5)
            put("<ul>" + "".join(f"<li>{line(2, 15)}</li>" for _ in range(n)) + "</ul>", True, n)
        elif pick < 0.8:
            put(f"<blockquote>{line(3, 40)}</blockquote>", True)
        elif pick < 0.83:
            put(f'{x}{line(2, 20)} <a href="/x">{words(1, 5)}</a> {line(1, 20)}{y}', True)
        elif pick < 0.92:
            rich(True)
        else:
            noise(True)
    if rng.random() < 0.15:
        x, y = named("div", talk)
        put(x + f"<p>{line(2, 30)}</p>" + y, False)
    out.append(b)
    if table:
        out.append("</td></tr></table>")
    if rng.random() < 0.4:
        x, y = named(rng.choice(["div", "section", "ol"]), talk)
        n = rng.randint(1, 5)
        put(x + "".join(f'<div class="comment"><p>{line(2, 30)}</p></div>' for _ in range(n)) + y, False, n)
    for _ in range(rng.choice([0, 0, 1, 2])):
        noise(False)
    if rng.random() < 0.2:
        a, b = rng.choice([named("div", sides), ("<aside>", "</aside>")])
        out.append(a)
        rich(False)
        out.append(b)
    out.extend(y for _, y in reversed(wraps[1:]))
    if rng.random() < 0.85:
        a, b = rng.choice([("<footer>", "</footer>"), ("<footer>", "</footer>"), named("div", ["footer", "bottom", "site-footer", "copyright"])])
        if open_layout and rng.random() < 0.3:
            put(f"<p>&copy; {rng.randint(1990, 2030)} {words(1, 6)}</p>", False)
        else:
            put(a + rng.choice([f"&copy; {word()} &middot; {line(2, 14)}", f"<p>{line(2, 14)}</p>"]) + b, False)
    out.extend(y for _, y in wraps[:1])
    return '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8">' + "".join(out) + rng.choice(["</body></html>", ""]), truth


def made_pages(n: int, seed: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Input rows and labels of ``n`` made-up pages."""
    rng = random.Random(seed)
    x, y = [], []
    while len(x) < n:
        page, truth = _made_page(rng)
        blocks = blocks_of(page)
        if len(blocks) == len(truth):
            x.append(vectors(blocks))
            y.append(np.array(truth, dtype=float))
    return x, y


@functools.lru_cache(maxsize=2)
def network(pages: int = 5000, epochs: int = 8, seed: int = 3) -> Network:
    """The trained labeller; ``pages`` made-up pages bound the training set."""
    return _train(*made_pages(pages, seed), epochs, seed)


def main_texts(net: Network, pages: list[str]) -> list[str]:
    read = [blocks_of(p) for p in pages]
    said = probabilities(net, [vectors(b) if b else np.zeros((0, INPUT)) for b in read])
    return ["\n".join(b.text for b, p in zip(blocks, ps) if p > 0.5) for blocks, ps in zip(read, said)]


def extract_text(html: Column) -> Column:
    """The main text of pages: blocks labelled so, in page order, joined by one
    line feed. Null, empty and text-free pages give an empty string; rows are
    independent, so repeated rows agree. Pages are read whole."""
    net = network()

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        out: list[str] = []
        for at in range(0, len(pages), 256):
            out += main_texts(net, [p.as_py() or "" for p in pages.slice(at, 256)])
        return pa.array(out, pa.string())

    return run(html)
