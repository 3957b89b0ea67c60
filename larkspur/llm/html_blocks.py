"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags, in page order. A
block is described by its path of tags, class and id words (hashed), by its own words (hashed) and by a
few counts. A bidirectional LSTM in numpy reads the sequence, so every block is judged with the whole page
around it, and labels each block as main text or not.

Fitted when an extraction is built, on a bounded sample of pages (``SAMPLE_PAGES``): as they are, with
labels from plain rules over tags and class names, and laid out anew in random templates (paragraphs, lists,
tables, glossaries, with what pages put beside them) in which the label of every block is known. Pages themselves are read whole, where they lie, without a shuffle.

* null or empty html, or a page without main blocks: empty text, 0 characters. Broken markup is read like
  a browser would as far as blocks need it: unclosed elements end with their parent.
* scripts, styles, text areas and titles run to their end tag. What stands in an element that is no text of the page
  (a button, a select, svg) is left out; one without an end tag takes only what comes before the next block-level tag.
* null page_id or url and repeated rows: each row on its own. An empty table gives an empty result.
* a very long page is one sequence; memory in proportion to its size. Columns go by name.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import bounded_sample, sigmoid

SAMPLE_PAGES, SAMPLE_CHARS, MADE_PAGES = 300, 30_000, 900
HIDDEN = 16
PATH_DIMS, WORD_DIMS = 96, 48
#: Blocks that one pass of the network holds.
PASS_BLOCKS = 20_000

# A tag up to its ``>``; quotes count only where a value begins with one that is closed.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)>""")
_TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
# References to numbers far beyond Unicode, whose digits a parser of numbers may refuse.
_HUGE = re.compile(r"&#(?:0*[1-9][0-9]{8,}|[xX]0*[1-9a-fA-F][0-9a-fA-F]{7,});?")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr "
    "math annotation annotation-xml maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw text: nothing inside counts up to the end tag, whatever it looks like.
_RAW = frozenset("script style textarea title".split())
_HIDDEN = frozenset("noscript template select option button svg iframe object".split())
_FLOW = frozenset(
    "address article aside blockquote center dd details dialog div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main nav ol p pre section table ul".split()
)
_CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())


#: Names of elements, classes, ids and roles that hold the article, and of what stands beside it.
_MAIN = frozenset("article main .article .main .content .post .entry .story .body".split())
_ASIDE = frozenset(
    "nav header footer aside form .nav .navbar .menu .sidebar .header .footer .ad .ads .advert .advertisement .sponsored .promo .banner .cookie .consent "
    ".notice .newsletter .subscribe .share .social .related .comment .comments .reply .breadcrumb .login .search .widget .pagination .popup .modal "
    ".commentlist .disqus .respond .responses .navigation .complementary .contentinfo".split()
)


class Path:
    """Open elements from the root to a place, as a pointer to the place above.

    Places with the same names are one object, so what is computed for one serves all blocks and pages.
    """

    __slots__ = ("above", "parts", "main", "beside", "seen", "below", "vector")

    def __init__(self, above: "Path | None", parts: tuple[str, ...]):
        self.above, self.parts, self.below, self.vector = above, parts, {}, None
        self.main = above is not None and above.main or not _MAIN.isdisjoint(parts)
        self.beside = above is not None and above.beside or not _ASIDE.isdisjoint(parts)
        #: one bit per hashed name anywhere on the path
        self.seen = above.seen if above is not None else 0
        for part in parts:
            self.seen |= 1 << zlib.crc32(part.encode()) % PATH_DIMS


class Block(NamedTuple):
    text: str
    path: Path
    linked: int


class _Places:
    """The places in use, from the root; begun anew when there are many."""

    def __init__(self, most: int = 20_000):
        self.most = most
        self.root, self.size = Path(None, ()), 0

    def __reduce__(self):
        return _Places, (self.most,)  # tasks begin with none

    def start(self) -> Path:
        if self.size > self.most:
            self.root, self.size = Path(None, ()), 0
        return self.root

    def below(self, path: Path, parts: tuple[str, ...]) -> Path:
        found = path.below.get(parts)
        if found is None:
            found = path.below[parts] = Path(path, parts)
            self.size += 1
        return found


_places = _Places()


class _Page:
    """Reads a page once, left to right; every step costs the same however much is open."""

    def __init__(self, page: str):
        self.page = page
        self.out: list[Block] = []
        self.names: list[str] = []
        self.paths = [_places.start()]
        #: places on the stack of the open elements by name, and of those that are not inline
        self.by_name: dict[str, list[int]] = {}
        self.walls: list[int] = []
        #: of every open hidden element: its place, the blocks before it, those before a block-level tag inside (or -1), the open links;
        #: in the first ``met`` of them such a tag was met
        self.hidden: list[list[int]] = []
        self.met = 0
        self.left_out: list[tuple[int, int]] = []
        self.parts: list[str] = []
        self.linked = self.links = 0

    def close(self) -> None:
        """Ends the block."""
        if self.parts:
            text = "".join(self.parts)
            if "&" in text:
                text = entities.unescape(_HUGE.sub("\ufffd", text))
            text = " ".join(text.split())
            if text:
                self.out.append(Block(text, self.paths[-1], self.linked))
            self.parts.clear()
        self.linked = 0

    def pop(self, place: int, ended: bool) -> None:
        """Ends the elements from this place on; ``ended`` says that the one there has its own end."""
        while self.hidden and self.hidden[-1][0] >= place:
            at, before, until, links = self.hidden.pop()
            whole = ended and at == place
            self.left_out.append((before, len(self.out) if whole or until < 0 else until))
            if whole:
                self.links = links
        self.met = min(self.met, len(self.hidden))
        while len(self.names) > place:
            self.by_name[self.names.pop()].pop()
            self.paths.pop()
        while self.walls and self.walls[-1] >= place:
            self.walls.pop()

    def text(self, a: int, b: int) -> None:
        self.parts.append(self.page[a:b])
        if self.links:
            self.linked += b - a

    def end_tag(self, name: str) -> None:
        inline = name in _INLINE
        if not inline:
            self.close()
        if name == "a":
            self.links = max(self.links - 1, 0)
        places = self.by_name.get(name)
        # an inline element is not closed from outside of the block-level one it stands in
        if places and not (inline and self.walls and self.walls[-1] > places[-1]):
            self.pop(places[-1], True)

    def start_tag(self, name: str, attributes: str) -> None:
        inline = name in _INLINE
        if not inline:
            self.close()
        if name in _VOID or name in _HIDDEN and attributes.endswith("/"):
            return
        if name in _CLOSES_ITSELF and self.walls and self.names[self.walls[-1]] == name:
            self.pop(self.walls[-1], True)
        if name == "a":
            self.links += 1
        if name in _HIDDEN:
            self.hidden.append([len(self.names), len(self.out), -1, self.links])
        elif not inline:
            self.links = 0
        if name in _FLOW:
            for h in self.hidden[self.met :]:
                h[2] = len(self.out)
            self.met = len(self.hidden)
        here = self.paths[-1]
        if name not in _HIDDEN:
            own: tuple[str, ...] = ()
            if "=" in attributes:
                own = tuple(f".{w}" for a, b, c in _NAMES.findall(attributes) for w in _PART.findall((a or b or c).lower()))
            here = _places.below(here, (name, *own))
        self.by_name.setdefault(name, []).append(len(self.names))
        if not inline:
            self.walls.append(len(self.names))
        self.names.append(name)
        self.paths.append(here)

    def read(self) -> list[Block]:
        page, size, last = self.page, len(self.page), self.page.rfind(">")
        at, quotes = 0, True
        while at < size:
            sign = page.find("<", at)
            if sign < 0 or sign > last:  # no tag ends any more: the rest is text
                sign = size
            if sign > at:
                self.text(at, sign)
                at = sign
                continue
            if page.startswith("<!--", at):
                end = page.find("-->", at + 2)
                at = end + 3 if end >= 0 else size
                continue
            if page.startswith(("<!", "<?"), at):
                at = page.find(">", at) + 1
                continue
            m = _TAG.match(page, at) if quotes else None
            if m is None:
                m = _TAG_NAME.match(page, at)
                if m is None:
                    self.text(at, at + 1)
                    at += 1
                    continue
                quotes = False  # a quote swallows the rest of the page: from here on a tag ends at the next ``>``
                end = page.find(">", m.end())
                attributes, at = page[m.end() : end], end + 1
            else:
                attributes, at = m[3], m.end()
            name = m[2].lower()
            if name == "br":
                self.parts.append(" ")
            elif m[1]:
                self.end_tag(name)
            elif name in _RAW:
                self.close()
                if not attributes.endswith("/"):
                    end = _raw_end(name).search(page, at, last + 1) if at <= last else None
                    at = end.end() if end else size
            else:
                self.start_tag(name, attributes)
        self.close()
        self.pop(0, False)
        if not self.left_out:
            return self.out
        inside = np.zeros(len(self.out) + 1, np.int64)
        for a, b in self.left_out:
            inside[a] += 1
            inside[max(a, b)] -= 1
        return [b for b, n in zip(self.out, np.cumsum(inside).tolist()) if n == 0]


@lru_cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*+>", re.IGNORECASE)


def blocks(page: str) -> list[Block]:
    """The leaf blocks with text, in page order: references decoded, white space single, trimmed. Linear in the page."""
    return _Page(page).read()


# ---- features -------------------------------------------------------------------------------------

_COUNTS = 14
DIMS = PATH_DIMS + WORD_DIMS + _COUNTS
#: The nearest names of a path that count one by one; farther ones count as there or not.
NEAREST = 8


def _path_vector(path: Path) -> np.ndarray:
    if path.vector is None:
        found, taken, at = np.zeros(PATH_DIMS, np.float32), 0, path
        while at.above is not None and taken < NEAREST:
            for part in at.parts:
                found[zlib.crc32(part.encode()) % PATH_DIMS] += 1.0
            taken += len(at.parts)
            at = at.above
        far = np.frombuffer(at.seen.to_bytes(PATH_DIMS // 8, "little"), np.uint8)
        path.vector = np.minimum(found + 0.5 * np.unpackbits(far, bitorder="little"), 1.5)
    return path.vector


def features(page: list[Block]) -> np.ndarray:
    """One row per block."""
    x = np.zeros((len(page), DIMS), np.float32)
    crc = zlib.crc32
    for k, block in enumerate(page):
        x[k, :PATH_DIMS] = _path_vector(block.path)
        words = block.text.encode().lower().split()
        hashed = np.bincount(np.fromiter((crc(w) for w in words), np.int64, len(words)) % WORD_DIMS, minlength=WORD_DIMS)
        x[k, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.log1p(hashed) / (1 + np.log1p(len(words)))
        size = len(block.text)
        x[k, PATH_DIMS + WORD_DIMS :] = (
            np.log1p(size) / 5, size < 25, size > 100, size > 400, min(block.linked / size, 1), len(words) / 50 if len(words) < 50 else 1,
            block.text[-1] in ".!?\"'", "©" in block.text or "opyright" in block.text, k / len(page), k == 0, k == len(page) - 1, block.path.main, block.path.beside, 1,
        )
    return x


# ---- the network ----------------------------------------------------------------------------------


class Net(NamedTuple):
    """Input, recurrent and bias weights of both directions, and the output weights."""

    wx: list[np.ndarray]
    wh: list[np.ndarray]
    b: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def start(seed: int = 1) -> Net:
    rng = np.random.default_rng(seed)
    b = np.zeros(4 * HIDDEN)
    b[HIDDEN : 2 * HIDDEN] = 1.0
    return Net(
        [rng.normal(0, 0.15, (DIMS, 4 * HIDDEN)) for _ in range(2)],
        [rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)) for _ in range(2)],
        [b.copy(), b.copy()],
        rng.normal(0, 0.3, 2 * HIDDEN),
        np.zeros(1),
    )


def _gates(z: np.ndarray) -> tuple[np.ndarray, ...]:
    h = HIDDEN
    return sigmoid(z[..., :h]), sigmoid(z[..., h : 2 * h]), sigmoid(z[..., 2 * h : 3 * h]), np.tanh(z[..., 3 * h :])


def predict(pages: list[np.ndarray], net: Net) -> list[np.ndarray]:
    """Probability of main text for every block of every page; step t of all pages at once, the longest first."""
    lengths = np.array([len(p) for p in pages])
    x = np.concatenate(pages) if pages else np.zeros((0, DIMS), np.float32)
    total = np.zeros(len(x))
    rank = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths)
    first, last, ordered = (ends - lengths)[rank], (ends - 1)[rank], lengths[rank]
    for d in range(2):
        z = x @ net.wx[d].astype(np.float32) + net.b[d].astype(np.float32)
        wh = net.wh[d].astype(np.float32)
        own = net.out[d * HIDDEN : (d + 1) * HIDDEN].astype(np.float32)
        h, c = np.zeros((len(pages), HIDDEN), np.float32), np.zeros((len(pages), HIDDEN), np.float32)
        for t in range(int(ordered[0]) if len(pages) else 0):
            n = int(np.searchsorted(-ordered, -t, side="left"))
            rows = first[:n] + t if d == 0 else last[:n] - t
            i, f, o, g = _gates(z[rows] + h[:n] @ wh)
            c = f * c[:n] + i * g
            h = o * np.tanh(c)
            total[rows] += h @ own
    return np.split(sigmoid(total + net.bias), ends[:-1]) if pages else []


def _gradients(x: np.ndarray, y: np.ndarray, mask: np.ndarray, net: Net) -> list[np.ndarray]:
    """Gradient of the mean log loss over a padded batch (T x B x D), by back-propagation through time."""
    steps, width, _ = x.shape
    kept, logit = [], np.full((steps, width), net.bias[0])
    for d in range(2):
        z = x @ net.wx[d] + net.b[d]
        h, c = np.zeros((width, HIDDEN)), np.zeros((width, HIDDEN))
        trace = {}
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            m = mask[t][:, None]
            gates = _gates(z[t] + h @ net.wh[d])
            i, f, o, g = gates
            new = f * c + i * g
            trace[t] = (h, c, gates, new)
            h, c = m * o * np.tanh(new) + (1 - m) * h, m * new + (1 - m) * c
            logit[t] += h @ net.out[d * HIDDEN : (d + 1) * HIDDEN]
        kept.append(trace)
    slope = (sigmoid(logit) - y) * mask / max(mask.sum(), 1)
    grads = [np.zeros_like(p) for p in (*net.wx, *net.wh, *net.b, net.out, net.bias)]
    grads[7] = np.array([slope.sum()])
    for d in range(2):
        own = net.out[d * HIDDEN : (d + 1) * HIDDEN]
        dh, dc = np.zeros((width, HIDDEN)), np.zeros((width, HIDDEN))
        dz_all = np.zeros((steps, width, 4 * HIDDEN))
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            m = mask[t][:, None]
            h0, c0, (i, f, o, g), new = kept[d][t]
            tanh = np.tanh(new)
            # what this step put out: the new state where the mask is set, else the old one
            grads[6][d * HIDDEN : (d + 1) * HIDDEN] += slope[t] @ (m * o * tanh + (1 - m) * h0)
            dh = dh + slope[t][:, None] * own
            dnew = m * (dc + dh * o * (1 - tanh**2))
            dz = np.hstack([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), m * dh * tanh * o * (1 - o), dnew * i * (1 - g**2)])
            dz_all[t] = dz
            grads[2 + d] += h0.T @ dz
            dh, dc = dz @ net.wh[d].T + (1 - m) * dh, dnew * f + (1 - m) * dc
        grads[d] += np.tensordot(x, dz_all, axes=([0, 1], [0, 1]))
        grads[4 + d] += dz_all.sum((0, 1))
    return grads


def train(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 1) -> Net:
    """A network from (features, labels) of pages, by Adam over batches of pages of similar length."""
    net, rng = start(seed), np.random.default_rng(seed)
    parts = [*net.wx, *net.wh, *net.b, net.out, net.bias]
    m, v, step = [0 * p for p in parts], [0 * p for p in parts], 0
    pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
    groups = [pages[k : k + batch] for k in range(0, len(pages), batch)]
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            group = groups[k]
            longest = min(max(len(x) for x, _ in group), 300)
            x, y, mask = np.zeros((longest, len(group), DIMS)), np.zeros((longest, len(group))), np.zeros((longest, len(group)))
            for j, (a, b) in enumerate(group):
                n = min(len(a), longest)
                x[:n, j], y[:n, j], mask[:n, j] = a[:n], b[:n], 1
            now = Net(parts[0:2], parts[2:4], parts[4:6], parts[6], parts[7])
            step += 1
            for j, g in enumerate(_gradients(x, y, mask, now)):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                parts[j] = parts[j] - rate * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
    return Net(parts[0:2], parts[2:4], parts[4:6], parts[6], parts[7])


# ---- what it learns from --------------------------------------------------------------------------

def rule_labels(page: list[Block]) -> np.ndarray:
    """Labels by plain rules: inside an article or main part and nothing that stands beside it."""
    beside = np.array([b.path.beside for b in page])
    main = np.array([b.path.main for b in page])
    if not (main & ~beside).any():
        main = np.array([len(b.text.split()) >= 15 and b.linked * 3 < len(b.text) for b in page])
    return (main & ~beside).astype(float)


_MARK = "\ue000"
_MAIN_FORMS = (
    "<article>{}</article>", "<main>{}</main>", '<main><article class="post">{}</article></main>', '<div class="content">{}</div>', '<div id="main-content"><div class="entry">{}</div></div>',
    '<section class="story-body">{}</section>', '<div class="article-text">{}</div>', '<div class="page"><div class="post-body">{}</div></div>', "<div>{}</div>", "<table><tr><td>{}</td></tr></table>",
    '<div role="main">{}</div>', '<div id="wrap"><div id="inner">{}</div></div>', "<section>{}</section>", '<div class="container"><div class="row"><div class="column">{}</div></div></div>', "{}",
)
_SIDE_FORMS = (
    '<nav><ul>{l}</ul></nav>', '<div class="menu"><ul>{l}</ul></div>', '<header><a href="/">{s}</a><p>{s}</p></header>', '<div class="header">{s}</div>', "<footer>&copy; {s}</footer>",
    '<div id="footer"><p>{s}</p><ul>{l}</ul></div>', "<aside><h3>{w}</h3><p>{p}</p></aside>", '<div class="sidebar"><h3>{w}</h3><ul>{l}</ul><p>{p}</p></div>', '<div class="ad">{s}</div>',
    '<div class="ad-banner"><p>{p}</p></div>', '<div class="sponsored"><a href="#">{p}</a></div>', '<div id="cookie-notice"><p>{p}</p><a href="#">{w}</a></div>', '<div class="consent-banner">{s}</div>',
    '<form action="/q"><label>{w}</label><p>{s}</p></form>', '<div class="newsletter"><p>{p}</p></div>', '<ul class="related">{l}</ul>', '<div class="share"><a href="#">{w}</a> <a href="#">{w}</a></div>',
    '<section id="comments"><h2>{w}</h2><div class="comment"><p>{p}</p></div><div class="comment"><p>{p}</p></div></section>', '<div class="comments"><ol><li><b>{w}</b> {p}</li><li>{p}</li></ol></div>',
    '<div class="breadcrumb"><a href="/">{w}</a> &gt; <a href="/x">{w}</a></div>', '<div class="social">{w}</div>', '<div class="popup"><p>{s}</p></div>', "<div><a href='#'>{w}</a> | <a href='#'>{w}</a></div>",
    '<div id="disqus_thread"><ul><li><p>{p}</p></li><li><p>{p}</p></li></ul></div>', '<div id="respond"><h3>{b}</h3><p>{s}</p></div>', '<ol class="commentlist"><li><b>{w}</b><p>{p}</p></li><li><p>{p}</p></li></ol>',
    '<section class="responses"><h3>{w}</h3><div><b>{w}</b><p>{p}</p></div></section>', "<div>&copy; 2024 {w}. {b}</div>", "<div>&copy; {w}. {b}</div>", "<div>{b} &copy; {w}</div>", "<p>&copy; 2019 {w} {b}</p>", "<div>{w}. {b}</div>", "<div>Copyright 2020 {w}. {b}</div>", "<div><p>{b}</p></div>", "<div>{b}</div>", "<p>{b}</p>", '<div class="site-info">{b} {w}</div>',
    '<div role="navigation"><ul>{l}</ul></div>', '<div role="complementary"><p>{p}</p></div>', '<div role="contentinfo">{s}</div>', '<div role="banner"><h1>{w}</h1></div>', '<table class="nav"><tr><td><a href="/">{w}</a></td><td><a href="/x">{w}</a></td></tr></table>',
    '<div><p><a href="/">{b}</a> <a href="/x">{b}</a></p></div>', "<ul>{l}</ul>",
    '<div class="advert"><p>{p}</p></div>', '<div class="advertisement">{s}</div>', '<div class="promo-box"><p>{p}</p></div>',
)
#: What pages say beside their text.
_BESIDE = (
    "All rights reserved.", "Privacy policy", "Terms of use", "Contact us", "Sign up for our newsletter", "We use cookies to improve this site.", "Leave a reply", "Log in to comment",
    "Share this", "Back to top", "Imprint", "Powered by a small shop", "Copyright 2023 by the publisher. All rights reserved.", "Alle Rechte vorbehalten", "Impressum", "Datenschutz",
    "Mentions légales", "Tous droits réservés", "Aviso legal", "Todos los derechos reservados", "Subscribe now", "Follow us", "Advertisement", "Read more", "Accept all", "Site map",
)
_PART_FORMS = (
    *("<p>{}</p>",) * 6, "<p><b>{}<br>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>", "<p><a href='#'>x</a> {}</p>", "<pre>{}</pre>", "<h2>{}</h2>", "<h3>{}</h3>",
    "<figure><img src=x><figcaption>{}</figcaption></figure>", "<section><h3>{}</h3><p>{}</p></section>", "<div><p>{}</p><p>{}</p></div>", "<blockquote><p>{}</p></blockquote>",
)


def made_page(rng: random.Random, texts: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page with a random layout around given paragraphs, and the labels of its blocks."""

    def words(low: int, high: int) -> str:
        pool = rng.choice(texts).split() or ["word"]
        at = rng.randrange(len(pool))
        return entities.escape(" ".join((pool[at:] + pool)[: rng.randrange(low, high)]))

    def own(low: int, high: int) -> str:
        return _MARK + words(low, high)

    def side() -> str:
        form = rng.choice(_SIDE_FORMS)
        fill = {
            "{l}": lambda: "".join(f'<li><a href="/{k}">{words(1, 4)}</a></li>' for k in range(rng.randrange(2, 9))),
            "{s}": lambda: words(3, 12),
            "{w}": lambda: words(1, 4),
            "{p}": lambda: words(10, 70),
            "{b}": lambda: rng.choice(_BESIDE),
        }
        return re.sub(r"\{[lswpb]\}", lambda m: fill[m[0]](), form)

    def listing() -> str:
        """A list, a table with headers or a glossary of the article, of short or long entries."""
        high = rng.choice((4, 12, 60))
        entry = rng.choice(("<li>{}</li>", "<li>{}", "<li><p>{}</p></li>"))
        kind = rng.choice("ulldt")
        if kind == "t":
            width = rng.randrange(1, 5)
            head = "".join(f"<th>{own(1, 4)}</th>" for _ in range(width))
            rows = "".join("<tr>" + "".join(f"<td>{own(1, 6)}</td>" for _ in range(width)) + "</tr>" for _ in range(rng.randrange(1, 5)))
            return f"<table><tr>{head}</tr>{rows}</table>"
        if kind == "d":
            return "<dl>" + "".join(f"<dt>{own(1, 4)}</dt><dd>{own(2, high + 2)}</dd>" for _ in range(rng.randrange(1, 5))) + "</dl>"
        entries = "".join(entry.format(own(1, high)) for _ in range(rng.randrange(1, 8)))
        return f"<{kind}l>{entries}</{kind}l>" if kind == "u" else f"<ol>{entries}</ol>"

    def part() -> str:
        if rng.random() < 0.2:
            return listing()
        form = rng.choice(_PART_FORMS)
        return form.format(*(own(1, 10) if form.startswith(("<h", "<fig")) else own(2, 120) for _ in range(form.count("{}"))))

    body = ""
    if rng.random() < 0.8:
        body += f"<h1>{own(3, 12)}</h1>"
    for _ in range(rng.randrange(1, 12)):
        body += part()
        if rng.random() < 0.12:
            body += side()
    page = "".join(side() for _ in range(rng.randrange(0, 4))) + rng.choice(_MAIN_FORMS).format(body) + "".join(side() for _ in range(rng.randrange(0, 4)))
    found = blocks(f"<html><body>{page}</body></html>")
    labels = np.array([float(_MARK in b.text) for b in found])
    return [b._replace(text=b.text.replace(_MARK, "") or "-") for b in found], labels


def fit(pages: list[str], seed: int = 1) -> Net:
    """A network from pages as they are and laid out anew. Equal pages in equal order give equal weights."""
    rng = random.Random(seed)
    parsed = [b for p in pages if (b := blocks(p))]
    known = [(features(b), rule_labels(b)) for b in parsed]
    texts = [b.text for page in parsed for b in page if len(b.text) > 60][:3000] or ["one two three four five six seven eight nine ten. " * 8]
    made = [made_page(rng, texts) for _ in range(MADE_PAGES)]
    return train(known + [(features(b), y) for b, y in made], seed=seed)


def learned(pages: DataFrame) -> Net:
    rows = bounded_sample(pages.select("url", "html"), "url", SAMPLE_PAGES).where(F.length("html") <= SAMPLE_CHARS).collect()
    return fit(sorted(r["html"] for r in rows))


# ---- on tables ------------------------------------------------------------------------------------


def main_texts(pages: list[str], net: Net) -> list[str]:
    """The main text of every page: its main blocks in page order, joined by one space."""
    out: list[str] = []
    group: list[list[Block]] = []

    def flush() -> None:
        filled = [g for g in group if g]
        labels = iter(predict([features(g) for g in filled], net))
        for g in group:
            out.append(" ".join(b.text for b, p in zip(g, next(labels)) if p >= 0.5) if g else "")
        group.clear()

    held = 0
    for page in pages:
        group.append(blocks(page))
        held += len(group[-1])
        if held > PASS_BLOCKS:
            flush()
            held = 0
    flush()
    return out


def text_column(html: Column, net: Net) -> Column:
    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found: list[str] = []
            for k in range(0, len(batch), 256):
                found += main_texts([x.as_py() or "" for x in batch.slice(k, 256)], net)
            yield pa.array(found, pa.string())

    return texts(html)


def extract(pages: DataFrame, net: Net | None = None) -> DataFrame:
    """page_id, url, main text and its number of code points, of every page."""
    done = pages.select("page_id", "url", text_column(F.col("html"), net or learned(pages)).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
