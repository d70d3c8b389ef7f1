"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks: the texts between block-level tags, inline markup joined, scripts, styles and comments left out.
Each block becomes a vector: the mean of hashed vectors of its tag path (tags, classes, ids, roles, parent and child), the
mean of hashed vectors of all its words, and a few numbers (length, links, depth, place).  A bidirectional LSTM in numpy
runs over the whole page in both directions, so each block is judged in the light of all others.  Blocks that it calls main
are joined in page order.

Training.  `fit` takes at most `MAX_PAGES` pages, those first in the order of a hash of their number, as a source of texts
and words only.  A rule lays these texts out anew in many page forms (with and without article and main tags, class names
of many kinds, menus, side bars, notices, adverts, forms, comments) where it is known which blocks are main.  Training and
the weights, some 100,000 numbers, are of fixed size; the weights are broadcast and every page is labelled where it is read.

Edge cases: NULL and empty pages and pages without a main block give an empty text; unclosed, crossed and stray tags are
read as browsers do for the cases that matter (a new block closes an open paragraph, an end tag closes what is open inside
it, text, <body> and what cannot stand in a head close an open head, an unknown end tag is skipped); an unfinished comment, script or tag reaches to the end; repeated rows get a row each;
NULL page_id and url are carried through; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressloom.llm import common

MAX_PAGES = 200
LAYOUTS, EPOCHS, BATCH, RATE, SEED = 2500, 8, 30, 0.01, 9
WORD_RATE = 0.05
PATH_BITS, WORD_BITS = 12, 12
PATH_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 16, 6, 7, 16
LABEL_BATCH = 64
#: So many of the blocks around a block are told to the labeller, from the innermost on; its text is not touched.
PATH_DEPTH = 64
CACHE = 100_000

# Elements whose text is never shown as text, elements inside a line, elements without an end tag.
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object canvas head title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("head html base basefont bgsound link meta title noscript noframes style script template".split())  # what does not end an open head
ALIKE = tuple(frozenset(kind.split()) for kind in ("li", "td th", "tr", "dt dd"))  # one ends the other
RAW = frozenset("script style textarea title noscript iframe xmp".split())

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")


class Block:
    __slots__ = ("text", "path", "links", "depth", "place")

    def __init__(self, text: str, path: tuple[str, ...], links: int, depth: int, place: int):
        self.text, self.path, self.links, self.depth, self.place = text, path, links, depth, place


def _element(tag: str, rest: str) -> tuple[str, ...]:
    """Path features of one element: its tag, and the tag with each word of its class, id and role."""
    if not rest:
        return (tag,)
    names = [tag]
    for m in _ATTRIBUTE.finditer(rest):
        kind = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if kind in ("hidden", "aria-hidden"):
            names.append(f"{kind}={value[:5]}")
        else:
            names += [f".{w}" for w in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())]
    return tuple(names)


class _Open:
    """The open elements of a page, with the places of each name, so that no end tag is searched for in vain."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.outer: list[int] = []  # places of the elements that are not inside a line

    def __len__(self) -> int:
        return len(self.stack)

    def last(self, *names: str) -> int:
        """The place of the innermost open element of these names, -1 without one."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def push(self, tag: str, element: tuple[str, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        self.stack.append((tag, element))

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            tag, _ = self.stack.pop()
            self.places[tag].pop()
            if tag not in INLINE:
                self.outer.pop()

    def ended_by(self, tag: str) -> int:
        """The place of the element that an end tag closes, -1 for none.

        The end of an element inside a line does not reach past the block that it stands in, that of a paragraph not past any
        other block, that of a list item not past its list.
        """
        place, outer = self.last(tag), self.outer[-1] if self.outer else -1
        reach = outer + 1 if tag in INLINE else outer if tag == "p" else self.last("ul", "ol") if tag == "li" else 0
        return place if place >= reach else -1

    def ended_before(self, tag: str) -> int:
        """The place of the element that the start of a block closes, -1 for none."""
        for place in reversed(self.outer):
            name = self.stack[place][0]
            if name == "p" or any(tag in kind and name in kind for kind in ALIKE):
                return place
            if not (tag == "tr" and name in ("td", "th")):
                return -1
        return -1

    def path(self) -> tuple[str, ...]:
        """Features of the innermost `PATH_DEPTH` blocks around."""
        names: list[str] = []
        before = "-" if len(self.outer) <= PATH_DEPTH else self.stack[self.outer[-PATH_DEPTH - 1]][0]
        for place in self.outer[-PATH_DEPTH:]:
            tag, element = self.stack[place]
            names += element
            names.append(f"{before}>{tag}")
            before = tag
        return tuple(names) or ("-",)


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; a block's text has its references decoded and its white space joined.

    The work grows with the length of the page, whatever its markup: each tag looks at a few places.
    """
    page = page or ""
    out: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    links, place = 0, 0  # characters inside links; blocks so far
    hidden = 0  # depth of the outermost hidden element, 0 without one

    def close() -> None:
        nonlocal links
        if pieces:
            raw = "".join(pieces)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(text, open_.path(), links, len(open_), place))
            pieces.clear()
        links = 0

    def cut(index: int) -> None:
        nonlocal hidden
        if hidden > index:
            hidden = 0
        open_.cut(index)

    def in_head() -> bool:
        return bool(hidden) and open_.stack[-1][0] == "head"

    def skip(start: int) -> int:
        """Past the end of a raw element."""
        found = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, start)
        return found.end() if found else len(page)

    at = 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        stop = m.start() if m else len(page)
        if in_head() and page[at:stop].strip():
            cut(len(open_) - 1)
        if stop > at and not hidden:
            piece = page[at:stop]
            pieces.append(piece)
            links += len(piece) if open_.places.get("a") else 0
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            ended = open_.ended_by(tag)
            if ended >= 0:
                if tag not in INLINE:
                    close()
                cut(ended)
            continue
        if in_head() and tag not in HEAD:
            cut(len(open_) - 1)
        elif hidden and tag == "body" and open_.places.get("head") and not open_.places.get("template"):
            cut(open_.places["head"][0])
        if tag in RAW and not (tag == "noscript"):
            if tag not in INLINE:
                close()
            at = skip(at)
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            close()
            place += 1
            ended = open_.ended_before(tag)
            if ended >= 0:
                open_.cut(ended)
        if tag in VOID:
            continue
        open_.push(tag, _element(tag, m[3].strip().rstrip("/")))
        if tag in HIDDEN_TAGS and not hidden:
            hidden = len(open_)
    close()
    return out


# --- vectors

_slots: dict[str, int] = {}


def _slot(name: str, bits: int) -> int:
    got = _slots.get(name)
    if got is None:
        if len(_slots) >= CACHE:
            _slots.clear()
        got = _slots[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF
    return got >> (32 - bits)


class Page:
    """Vectors of a page's blocks: slots of paths and of words with their blocks, and numbers."""

    __slots__ = ("size", "path", "path_of", "word", "word_of", "numbers")

    def __init__(self, found: list[Block]):
        self.size = len(found)
        paths = [[_slot(n, PATH_BITS) for n in b.path] for b in found]
        words = [[_slot(w, WORD_BITS) for w in b.text.split(" ")] for b in found]
        flat = lambda lists: np.array([x for one in lists for x in one], np.int64)
        spread = lambda lists: np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.path, self.path_of, self.word, self.word_of = flat(paths), spread(paths), flat(words), spread(words)
        n = max(len(found), 1)
        self.numbers = np.array(
            [
                (
                    np.log1p(len(b.text)) / 5,
                    min(b.links / len(b.text), 1.0),
                    np.log1p(len(w)) / 4,
                    b.depth / 10,
                    k / n,
                    float(b.text[-1] in ".!?"),
                    1.0,
                )
                for k, (b, w) in enumerate(zip(found, words))
            ],
            np.float32,
        ).reshape(len(found), NUMBERS)


def _mean(table: np.ndarray, slots: np.ndarray, of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.maximum(np.bincount(of, minlength=size), 1).astype(np.float32)
    if not len(slots):
        return np.zeros((size, table.shape[1]), np.float32), counts
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    sums = np.zeros((size, table.shape[1]), np.float32)
    sums[of[starts]] = np.add.reduceat(table[slots], starts, axis=0)
    return sums / counts[:, None], counts


# --- the network

Weights = dict[str, np.ndarray]
WIDTH = PATH_SIZE + WORD_SIZE + NUMBERS


def fresh(seed: int = SEED) -> Weights:
    rng = np.random.default_rng(seed)
    w: Weights = {"paths": rng.normal(0, 0.3, (1 << PATH_BITS, PATH_SIZE)), "words": rng.normal(0, 0.1, (1 << WORD_BITS, WORD_SIZE))}
    for side in ("f", "b"):
        w[f"x{side}"] = rng.normal(0, WIDTH**-0.5, (WIDTH, 4 * HIDDEN))
        w[f"h{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        w[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    w["out"] = rng.normal(0, 0.3, (2 * HIDDEN + WIDTH, 1))
    w["bias"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _inputs(w: Weights, pages: list[Page]) -> tuple[np.ndarray, np.ndarray, list]:
    """(time, page, WIDTH) padded with zeros, the mask, and what the gradient of the tables needs."""
    longest = max(p.size for p in pages)
    x = np.zeros((longest, len(pages), WIDTH), np.float32)
    mask = np.zeros((longest, len(pages), 1), np.float32)
    kept = []
    for k, p in enumerate(pages):
        a, a_counts = _mean(w["paths"], p.path, p.path_of, p.size)
        b, b_counts = _mean(w["words"], p.word, p.word_of, p.size)
        x[: p.size, k] = np.concatenate([a, b, p.numbers], axis=1)
        mask[: p.size, k] = 1
        kept.append((a_counts, b_counts))
    return x, mask, kept


def _run(w: Weights, side: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states of one direction; where the mask is 0 the state stays as it is."""
    steps, count, _ = x.shape
    projected = x @ w[f"x{side}"] + w[f"c{side}"]
    h, c = np.zeros((count, HIDDEN), np.float32), np.zeros((count, HIDDEN), np.float32)
    out, past = np.zeros((steps, count, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = projected[t] + h @ w[f"h{side}"]
        ifo = _sigmoid(gates[:, : 3 * HIDDEN])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        g = np.tanh(gates[:, 3 * HIDDEN :])
        now = f * c + i * g
        m = mask[t]
        tanh = np.tanh(now)
        if keep:
            past.append((t, h, c, i, f, o, g, tanh))
        c = m * now + (1 - m) * c
        h = m * (o * tanh) + (1 - m) * h
        out[t] = h
    return out, past


def probabilities(w: Weights, pages: list[Page]) -> list[np.ndarray]:
    x, mask, _ = _inputs(w, pages)
    states = [_run(w, side, x, mask, False)[0] for side in "fb"]
    scores = _sigmoid(np.concatenate([*states, x], axis=2) @ w["out"] + w["bias"])[:, :, 0]
    return [scores[: p.size, k] for k, p in enumerate(pages)]


def gradients(w: Weights, pages: list[Page], truth: list[np.ndarray]) -> tuple[float, Weights]:
    """Mean cross-entropy over the blocks, and its gradient by all weights."""
    x, mask, kept = _inputs(w, pages)
    runs = {side: _run(w, side, x, mask, True) for side in "fb"}
    joined = np.concatenate([runs["f"][0], runs["b"][0], x], axis=2)
    p = _sigmoid(joined @ w["out"] + w["bias"])
    y = np.zeros_like(p)
    for k, labels in enumerate(truth):
        y[: len(labels), k, 0] = labels
    total = mask.sum()
    loss = float(-(mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / total)
    d = (p - y) * mask / total
    grad: Weights = {"out": joined.reshape(-1, joined.shape[2]).T @ d.reshape(-1, 1), "bias": d.sum(axis=(0, 1))}
    back = d @ w["out"].T
    dx = back[:, :, 2 * HIDDEN :].copy()
    for n, side in enumerate("fb"):
        outer = back[:, :, n * HIDDEN : (n + 1) * HIDDEN]
        dh, dc = np.zeros_like(outer[0]), np.zeros_like(outer[0])
        dgates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        grad[f"h{side}"] = np.zeros_like(w[f"h{side}"])
        for t, h, c, i, f, o, g, tanh in reversed(runs[side][1]):
            m = mask[t]
            dh = dh + outer[t]
            inner_h, inner_c = m * dh, m * dc
            inner_c = inner_c + inner_h * o * (1 - tanh**2)
            gate = np.concatenate([inner_c * g * i * (1 - i), inner_c * c * f * (1 - f), inner_h * tanh * o * (1 - o), inner_c * i * (1 - g**2)], axis=1)
            dgates[t] = gate
            grad[f"h{side}"] += h.T @ gate
            dh = (1 - m) * dh + gate @ w[f"h{side}"].T
            dc = (1 - m) * dc + inner_c * f
        grad[f"x{side}"] = x.reshape(-1, WIDTH).T @ dgates.reshape(-1, 4 * HIDDEN)
        grad[f"c{side}"] = dgates.sum(axis=(0, 1))
        dx += dgates @ w[f"x{side}"].T
    grad["paths"], grad["words"] = np.zeros_like(w["paths"]), np.zeros_like(w["words"])
    for k, (page, (a, b)) in enumerate(zip(pages, kept)):
        own = dx[: page.size, k]
        np.add.at(grad["paths"], page.path, (own[:, :PATH_SIZE] / a[:, None])[page.path_of])
        np.add.at(grad["words"], page.word, (own[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / b[:, None])[page.word_of])
    return loss, grad


def train(examples: list[tuple[Page, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """Adam over batches of pages of similar length.

    Words learn slowly: the sample repeats its few texts in every part of a page, and they should not be learnt by heart.
    """
    w = fresh(seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order = random.Random(seed)
    examples = sorted((e for e in examples if e[0].size), key=lambda e: e[0].size)
    batches = [examples[k : k + BATCH] for k in range(0, len(examples), BATCH)]
    step = 0
    for _ in range(epochs):
        order.shuffle(batches)
        for batch in batches:
            step += 1
            _, grad = gradients(w, [p for p, _ in batch], [t for _, t in batch])
            rate = RATE * (1 - step / (epochs * len(batches) + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                w[k] -= ((WORD_RATE if k == "words" else 1.0) * rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return w


# --- training pages

# Names that sites give to the parts of a page.
MAIN_NAMES = "content article article-body post post-content entry-content story story-body main-content text page-content body-text entry main".split()
OTHER_NAMES = {
    "menu": "nav menu navbar main-menu navigation topnav breadcrumb breadcrumbs site-nav links toc pagination".split(),
    "header": "header masthead site-header top banner branding logo topbar page-header".split(),
    "footer": "footer site-footer bottom page-footer copyright legal colophon".split(),
    "side": "sidebar side aside widget related related-posts recommended rail secondary popular trending tags archive".split(),
    "notice": "notice cookie cookie-notice consent gdpr alert banner popup modal overlay message newsletter subscribe".split(),
    "advert": "ad ads advert advertisement sponsored promo promotion ad-slot banner-ad sponsor".split(),
    "form": "form search search-form login contact signup subscribe-form".split(),
    "comments": "comments comment comment-list reader-comments responses discussion replies disqus".split(),
}
USUAL = {
    "menu": "Home;About;Contact;News;Archive;Login;Next;Previous;Blog;Products".split(";"),
    "header": "Welcome;Daily News;My Site;Skip to content".split(";"),
    "footer": "© 2024 Example;All rights reserved.;Privacy;Terms of use;Imprint".split(";"),
    "side": "Related;Most read;Popular;Tags;You may also like".split(";"),
    "notice": "We use cookies to improve this site.;Accept;Subscribe to our newsletter".split(";"),
    "advert": "Advertisement;Sponsored;Buy now;Special offer".split(";"),
    "form": "Search;Name;E-mail;Send;Password".split(";"),
    "comments": "Comments;Reply;3 comments;Leave a comment;Anonymous says:".split(";"),
}


def layout(texts: list[str], rng: random.Random) -> tuple[str, set[str]]:
    """A page that lays out some of the texts by chance, and the marks of its main blocks.

    Every text carries a mark, a number in brackets, by which the blocks that the parser finds get their labels; the marks
    are taken off before the vectors are made.
    """
    main: set[str] = set()
    counter = [0]

    def mark(text: str, is_main: bool) -> str:
        counter[0] += 1
        sign = f"⟦{counter[0]}⟧"
        if is_main:
            main.add(sign)
        return sign + entities.escape(text, quote=False)

    def sentence() -> str:
        return rng.choice(texts)

    def short() -> str:
        words = sentence().split()
        start = rng.randrange(len(words))
        return " ".join(words[start : start + rng.randrange(1, 5)])

    def named(tags: tuple[str, ...], names: list[str], inner: str, bare: float = 0.0) -> str:
        tag = rng.choice(tags)
        if rng.random() < bare:
            return f"<{tag}>{inner}</{tag}>"
        return f'<{tag} {rng.choice(("class", "class", "id"))}="{rng.choice(names)}">{inner}</{tag}>'

    def part(kind: str) -> str:
        names, usual = OTHER_NAMES[kind], USUAL[kind]
        text = lambda: mark(rng.choice(usual) if rng.random() < 0.4 else rng.choice((short, sentence))(), False)
        link = lambda: f'<a href="/{counter[0]}">{mark(rng.choice(usual) if rng.random() < 0.3 else short(), False)}</a>'
        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randrange(1, 9)))
        lists = f"<ul>{items}</ul>"
        paragraphs = "".join(f"<p>{text()}" + rng.choice(("</p>", "")) for _ in range(rng.randrange(1, 4)))
        if kind == "menu":
            return named(("nav", "nav", "div", "ul"), names, rng.choice((lists, items, " ".join(link() for _ in range(4)))), 0.4) if rng.random() < 0.8 else f"<nav>{lists}</nav>"
        if kind == "header":
            inner = rng.choice((f"<h1>{text()}</h1>", f"<p>{text()}</p>", text(), f"<h1>{text()}</h1>{lists}"))
            return f"<header>{inner}</header>" if rng.random() < 0.4 else named(("header", "div"), names, inner)
        if kind == "footer":
            inner = rng.choice((text(), paragraphs, f"{paragraphs}{lists}", f"{text()}<br>{text()}", f"&copy; {text()} &middot; {text()}"))
            return f"<footer>{inner}</footer>" if rng.random() < 0.6 else named(("footer", "div"), names, inner)
        if kind == "side":
            inner = rng.choice((f"<h3>{text()}</h3>{lists}", paragraphs, f"<h2>{text()}</h2>{paragraphs}", text()))
            return f"<aside>{inner}</aside>" if rng.random() < 0.4 else named(("aside", "div", "section"), names, inner)
        if kind == "form":
            inner = f"<label>{text()}</label><input name=q><button>{text()}</button>" + rng.choice(("", paragraphs, f"<select><option>{text()}</option></select>"))
            return f"<form>{inner}</form>" if rng.random() < 0.6 else named(("form", "div"), names, inner)
        if kind == "comments":
            each = "".join(rng.choice((f"<li>{text()}</li>", f"<div class=\"comment\"><p>{text()}</p></div>", f"<p>{text()}</p>")) for _ in range(rng.randrange(1, 6)))
            return named(("div", "section", "ol", "aside"), names, f"<h3>{text()}</h3>{each}")
        return named(("div", "div", "p", "section", "aside"), names, rng.choice((text(), paragraphs, f"{text()}<button>{text()}</button>")))

    def body() -> str:
        title = rng.choice(("h1", "h1", "h2"))
        out = [f"<{title}>{mark(short(), True)}</{title}>"] if rng.random() < 0.85 else []
        for _ in range(rng.randrange(1, 14)):
            form, text = rng.random(), mark(rng.choice((sentence, sentence, sentence, short))(), True)
            if form < 0.7:
                out.append(rng.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<p>{text} <a href='/x'>{entities.escape(short())}</a> {entities.escape(short())}</p>")))
            elif form < 0.78:
                out.append(f"<h{rng.choice('234')}>{text}</h{rng.choice('234')}>" if rng.random() < 0.1 else f"<h2>{text}</h2>")
            elif form < 0.86:
                out.append("<ul>" + "".join(f"<li>{mark(sentence(), True)}</li>" for _ in range(rng.randrange(1, 5))) + f"</ul><p>{text}</p>")
            elif form < 0.92:
                out.append(f"<blockquote>{rng.choice((text, f'<p>{text}</p>'))}</blockquote>")
            elif form < 0.96:
                out.append(f"<table><tr><td>{text}</td><td>{mark(short(), True)}</td></tr></table>")
            else:
                out.append(f"<div>{text}</div>")
            if rng.random() < 0.06:
                out.append(part(rng.choice(("advert", "side", "form", "notice"))))
        if rng.random() < 0.12:
            out.append(part("comments"))
        return "".join(out)

    inner = body()
    form = rng.random()
    if form < 0.4:
        inner = f"<article>{inner}</article>"
    elif form < 0.5:
        inner = f"<main>{inner}</main>"
    elif form < 0.6:
        inner = f"<main><article>{inner}</article></main>"
    else:
        inner = named(("div", "div", "section", "article", "td"), MAIN_NAMES, inner)
    above = [part(k) for k in ("notice", "header", "menu", "menu", "advert", "form", "side") if rng.random() < 0.4]
    below = [part(k) for k in ("side", "comments", "advert", "form", "menu", "notice", "footer", "footer") if rng.random() < 0.4]
    rng.shuffle(above)
    page = "".join([*above, inner, *below])
    if rng.random() < 0.4:
        page = f'<div class="{rng.choice(("page", "wrapper", "container", "site", "layout"))}">{page}</div>'
    return f"<!DOCTYPE html><html><head><title>{entities.escape(short())}</title></head><body>{page}</body></html>", main


_SIGN = re.compile("⟦[0-9]+⟧")


def examples(texts: list[str], count: int = LAYOUTS, seed: int = SEED) -> Iterator[tuple[Page, np.ndarray]]:
    rng = random.Random(seed)
    texts = [t for t in texts if t.split()] or ["Some words about a thing.", "More words about other things, and a question?"]
    for _ in range(count):
        page, main = layout(texts, rng)
        found = blocks(page)
        truth = np.array([float(any(s in main for s in _SIGN.findall(b.text))) for b in found], np.float32)
        for b in found:
            b.text = _SIGN.sub("", b.text) or "-"
        yield Page(found), truth


# --- pages


def fit(pages: DataFrame, limit: int = MAX_PAGES) -> Weights:
    """Weights trained on layouts of the block texts of at most `limit` pages."""
    chosen = pages.select("page_id").where(F.col("page_id").isNotNull()).distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(limit)
    some = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")

    @F.pandas_udf(StringType())
    def excerpt(htmls: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(b.text for b in blocks(h)) for h in htmls], dtype=object)

    rows = some.select("page_id", excerpt(common.whole("html")).alias("t")).orderBy(F.xxhash64("page_id"), "page_id", "t").limit(limit).collect()
    weights = train(list(examples([line for r in rows for line in r["t"].split("\n")])))
    _slots.clear()  # or the words of the training pages would travel with the functions
    return weights


def label(weights: Weights, htmls: list[str | None]) -> list[str]:
    """The main text of each page."""
    parsed = [blocks(h) for h in htmls]
    order = sorted((k for k in range(len(parsed)) if parsed[k]), key=lambda k: len(parsed[k]))
    out = [""] * len(parsed)
    at = 0
    while at < len(order):
        size = 1  # a long page goes with fewer others, so a batch has a bounded size
        while at + size < len(order) and size < LABEL_BATCH and (size + 1) * len(parsed[order[at + size]]) <= 20_000:
            size += 1
        some = order[at : at + size]
        for k, p in zip(some, probabilities(weights, [Page(parsed[k]) for k in some])):
            out[k] = "\n".join(b.text for b, x in zip(parsed[k], p) if x >= 0.5)
        at += size
    return out


def extractor(spark, weights: Weights) -> Callable[[Column], Column]:
    common.small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf(StringType())
    def extract(htmls: pd.Series) -> pd.Series:
        return pd.Series(label(shared.value, list(htmls)), dtype=object)

    return extract


def report(pages: DataFrame) -> DataFrame:
    text = extractor(pages.sparkSession, fit(pages))(common.whole("html"))
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
